"""Missing values: find, mark, drop and fill them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.functions import known, mean, not_a_number
from meterlab.plans.blocks import BLOCK_ROWS, attach, over_ordered

MISSING_TOKENS = ("", "?", "NA", "N/A", "NULL", "NaN")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, wide: bool = False) -> DataFrame:
    """Rows, NULLs, NaNs and share missing of each column, in one pass.

    Long form has one row per column; wide form one row with ``<col>_nulls``
    and so on.
    """
    cols = list(cols or df.columns)
    counts = [F.count("*").alias("n_rows")]
    for c in cols:
        counts += [
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
            F.count_if(not_a_number(F.col(c), df.schema[c].dataType)).alias(f"{c}_nans"),
        ]
    counted = df.agg(*counts)

    def share(c: str) -> Column:
        return F.try_divide(F.col(f"{c}_nulls") + F.col(f"{c}_nans"), F.col("n_rows"))

    if wide:
        return counted.withColumns({f"{c}_share_missing": share(c) for c in cols})
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("n_rows"),
            F.col(f"{c}_nulls").alias("n_null"),
            F.col(f"{c}_nans").alias("n_nan"),
            share(c).alias("share_missing"),
        )
        for c in cols
    ]
    return counted.select(F.inline(F.array(*rows)))


def null_tokens(
    df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Turn text that stands for a missing value into NULL; blanks around it are ignored."""
    return df.withColumns({c: F.when(~F.trim(c).isin(*tokens), F.col(c)) for c in cols})


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """Remove rows in which any (or all) of the columns are NULL or NaN."""
    return df.na.drop(how, subset=list(cols) if cols else None)


def fill_constant(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace NULL and NaN by one value per column."""
    return df.na.fill(dict(values))


def fill_mean(
    df: DataFrame,
    col: str = "power_kw",
    by: Sequence[str] = ("meter_id",),
    scale: int | None = None,
) -> DataFrame:
    """Replace NULL by the mean of the key's known values.

    It looks at the whole series, so use it for analysis and never before a
    split. The means are aggregated and joined back; a window would gather all
    rows of a meter in one task.
    """
    by = list(by)
    value = known(F.col(col), df.schema[col].dataType)
    if not by:
        return df.withColumn(col, F.coalesce(value, df.agg(mean(value, scale)).scalar()))
    with_mean = attach(df, by, mean(value, scale).alias("_mean"))
    return with_mean.withColumn(col, F.coalesce(value, F.col("_mean"))).select(*df.columns)


def impute_stage(cols: Sequence[str], strategy: str = "mean", suffix: str = "_filled") -> Imputer:
    """Stage that learns mean, median or mode from the data it is fitted on.

    Fit it on the training part only. The median is a value of the data, not
    the midpoint between two.
    """
    return Imputer(
        inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols], strategy=strategy
    )


def fill_forward(
    df: DataFrame,
    col: str = "power_kw",
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Replace NULL by the key's last known value; leading NULLs stay.

    ``order`` should identify the row (for example ``("ts", "event_id")``), or
    readings at equal times come in no fixed order.
    """
    clean = df.withColumn(col, known(F.col(col), df.schema[col].dataType))

    def last_known(series):
        so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {col: F.last(col, ignorenulls=True).over(so_far)}

    return over_ordered(
        clean,
        by,
        order,
        last_known,
        reach=1,
        cols=[col],
        keep=F.col(col).isNotNull(),
        block_rows=block_rows,
        split=split,
    ).select(*df.columns)
