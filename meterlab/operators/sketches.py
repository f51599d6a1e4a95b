"""Stored sketches of quantiles and distinct values, merged later without the readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from meterlab.functions import known

# Items that a quantile sketch keeps per level: a rank error of about 1.3 %.
ITEMS = 200
# Two to this power are the registers of a sketch of distinct values: about 1.6 % error.
REGISTERS = 12


def sketch_table(
    df: DataFrame,
    col: str = "power_kw",
    by: Sequence[str] = ("date",),
    distinct: str = "meter_id",
    ts: str = "ts",
    items: int = ITEMS,
    registers: int = REGISTERS,
) -> DataFrame:
    """One row per group: ``n``, ``low``, ``high``, and sketches of ``col`` and of the ids in ``distinct``.

    Without a ``date`` column the date of ``ts`` is taken for it. NULL and NaN are no values; ids
    count whatever the value is. Sketches are partially aggregated before the shuffle and are a few kilobytes
    each, whatever the rows behind them. Store the table (``write_table``); late dates can be sketched alone
    and merged with the rest.
    """
    if "date" in by and "date" not in df.columns:
        df = df.withColumn("date", F.to_date(ts))
    value = known(F.col(col), df.schema[col].dataType).cast("double")
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.kll_sketch_agg_double(value, items).alias("values_sketch"),
        F.hll_sketch_agg(F.col(distinct), registers).alias("ids_sketch"),
    )


def merge_sketches(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of :func:`sketch_table` merged into one per group, in the same form."""
    return table.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("values_sketch").alias("values_sketch"),
        F.hll_union_agg("ids_sketch").alias("ids_sketch"),
    )


def sketched(table: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What the sketches say: ``q<percent>`` per quantile and ``distinct_ids``, in the place of the sketches."""
    some = F.col("n") > 0
    at = {
        f"q{q * 100:g}".replace(".", "_"): F.when(some, F.kll_sketch_get_quantile_double("values_sketch", F.lit(float(q))))
        for q in quantiles
    }
    told = table.withColumns(at | {"distinct_ids": F.hll_sketch_estimate("ids_sketch")})
    return told.drop("values_sketch", "ids_sketch")
