"""Exploratory aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from meterlab.functions import bucket, known, mean, total
from meterlab.operators.features import CALENDAR_PARTS
from meterlab.plans.blocks import (
    BLOCK_ROWS,
    attach,
    join_on,
    running_total,
    settle,
)

QUARTILES = (0.25, 0.5, 0.75)


def trend(
    df: DataFrame,
    step: str = "day",
    col: str = "power_kw",
    ts: str = "ts",
    by: Sequence[str] = (),
    scale: int | None = None,
) -> DataFrame:
    """Readings, total, mean and highest value per day, week, month, ..."""
    value = known(F.col(col), df.schema[col].dataType)
    return df.groupBy(*by, bucket(F.col(ts), step).alias("bucket")).agg(
        F.count("*").alias("n_readings"),
        total(value, scale).alias("total"),
        mean(value, scale).alias("mean"),
        F.max(value).alias("max"),
    )


def load_profile(
    df: DataFrame,
    by: Sequence[str] = ("hour",),
    col: str = "power_kw",
    ts: str = "ts",
    scale: int | None = None,
    wide: bool = False,
) -> DataFrame:
    """Mean by calendar part(s); ``wide`` puts the hours of the day into columns h0 ... h23."""
    parts = {p: CALENDAR_PARTS[p](F.col(ts)) for p in by}
    value = known(F.col(col), df.schema[col].dataType)
    if not wide:
        return df.groupBy(*[c.alias(p) for p, c in parts.items()]).agg(
            F.count("*").alias("n_readings"), mean(value, scale).alias("mean")
        )
    rows = [p for p in parts if p != "hour"]
    keyed = df.select(*[parts[p].alias(p) for p in rows], F.hour(ts).alias("_hour"), value.alias(col))
    columns = []
    for hour in range(24):
        here = F.when(F.col("_hour") == hour, F.col(col))
        columns.append(mean(here, scale).alias(f"h{hour}"))
    return keyed.groupBy(*rows).agg(F.count("*").alias("n_readings"), *columns)


def exact_quantiles(
    df: DataFrame,
    col: str,
    by: Sequence[str] = (),
    quantiles: Sequence[float] = QUARTILES,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Exact interpolated quantiles ``q25``, ``q50``, ... of groups of any size.

    ``percentile`` keeps all distinct values of a group in one task's memory.
    Here values are counted first (aggregated before the shuffle), the counts
    summed up in value order, and each quantile read off at its rank.
    """
    by = list(by)
    value = known(F.col(col), df.schema[col].dataType).cast("double")
    values = df.select(*by, value.alias("_value")).where(F.col("_value").isNotNull())
    # The counts are looked at, split, laid out and summed up: stored once.
    counted = settle(values.groupBy(*by, "_value").agg(F.count("*").alias("_n")), "value-counts")
    ranked = running_total(counted, by, ["_value"], "_n", "_upto", block_rows, split)
    if by:
        ranked = attach(ranked, by, F.sum("_n").alias("_size"), of=counted)
    else:
        ranked = ranked.withColumn("_size", counted.agg(F.sum("_n")).scalar())
    after, upto = F.col("_upto") - F.col("_n"), F.col("_upto")
    ends, results = [], []
    for q in quantiles:
        name = quantile_name(q)
        rank = F.lit(float(q)) * (F.col("_size") - 1)
        for side, at in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            here = (after <= at) & (at < upto)
            ends.append(F.max(F.when(here, F.col("_value"))).alias(f"_{name}_{side}"))
        ends.append(F.max(rank - F.floor(rank)).alias(f"_{name}_part"))
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        results.append((low + (high - low) * F.col(f"_{name}_part")).alias(name))
    return ranked.groupBy(*by).agg(*ends).select(*by, *results)


def quantile_name(q: float) -> str:
    """0.25 -> q25, 0.999 -> q99_9."""
    return f"q{q * 100:g}".replace(".", "_")


def summarise(
    df: DataFrame,
    col: str = "power_kw",
    by: Sequence[str] = (),
    quantiles: Sequence[float] = QUARTILES,
    exact: bool = True,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Count, mean, spread, shape and quantiles of the known values, per group.

    Skewness and kurtosis are the population forms. Exact quantiles come from
    :func:`exact_quantiles`, whatever the size of a group; ``exact=False`` uses a
    sketch of fixed size.
    """
    by = list(by)
    value = known(F.col(col), df.schema[col].dataType)
    moments = [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("kurtosis"),
    ]

    def with_quantiles(how) -> DataFrame:
        ordered = [how(value, F.lit(q)).alias(quantile_name(q)) for q in quantiles]
        return df.groupBy(*by).agg(*moments, *ordered)

    if not exact:
        return with_quantiles(lambda v, q: F.percentile_approx(v, q, 10_000))
    ordered = exact_quantiles(df, col, by, quantiles, block_rows, split)
    described = df.groupBy(*by).agg(*moments)
    if by:
        return join_on(described, ordered, by)
    # Two tables of one row each: put them side by side by grouping, not by a join.
    names = [quantile_name(q) for q in quantiles]
    return (
        described.unionByName(ordered, allowMissingColumns=True)
        .agg(*[F.max(c).alias(c) for c in [*described.columns, *names]])
    )


def histogram(df: DataFrame, col: str = "power_kw", width: float = 10.0) -> DataFrame:
    """Rows per bin ``[bin * width, (bin + 1) * width)``; missing values form the NULL bin."""
    value = known(F.col(col), df.schema[col].dataType).cast("double")
    number = F.floor(value / F.lit(float(width)))
    return (
        df.groupBy(number.cast("bigint").alias("bin"))
        .agg(F.count("*").alias("n"))
        .withColumn("bin_start", F.col("bin") * F.lit(float(width)))
        .select("bin", "bin_start", "n")
    )


def correlations(
    df: DataFrame, cols: Sequence[str] = (), pairs: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Pearson correlation of all pairs of ``cols`` or of the given pairs, in one pass.

    Rows that lack one of the two values, or have NaN there, do not count. A constant column
    correlates with nothing: NULL (``corr`` would fail on it in ANSI mode).
    """
    chosen = list(pairs) or list(combinations(cols, 2))

    def both(a: str, b: str) -> tuple[Column, Column]:
        x, y = (known(F.col(c), df.schema[c].dataType).cast("double") for c in (a, b))
        return F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)

    measured = []
    for i, (a, b) in enumerate(chosen):
        x, y = both(a, b)
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        measured += [
            F.try_divide(F.covar_pop(x, y), spread).alias(f"r{i}"),
            F.count(x).alias(f"n{i}"),
        ]
    rows = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            F.col(f"n{i}").alias("n"),
            F.col(f"r{i}").alias("corr"),
        )
        for i, (a, b) in enumerate(chosen)
    ]
    return df.agg(*measured).select(F.inline(F.array(*rows)))


def share(
    df: DataFrame,
    by: Sequence[str] = ("channel",),
    period: str = "day",
    col: str = "power_kw",
    ts: str = "ts",
    scale: int | None = None,
) -> DataFrame:
    """Each group's total and its part of the total of the period.

    A window would gather all groups of a period in one task. The sums of the groups
    are stored, and the totals of the few periods come from them.
    """
    timed = df.withColumn("bucket", bucket(F.col(ts), period))
    value = known(F.col(col), df.schema[col].dataType)
    added = value.cast("double") if scale is None else value.cast(f"decimal(18,{scale})")
    groups = settle(timed.groupBy("bucket", *by).agg(F.sum(added).alias("_sum")), "shares")
    whole = attach(groups, ["bucket"], F.sum("_sum").cast("double").alias("_all"))
    total_of_group = F.col("_sum").cast("double")
    return whole.select(
        "bucket",
        *by,
        total_of_group.alias("total"),
        F.try_divide(total_of_group, F.col("_all")).alias("share"),
    )


def plot_table(df: DataFrame, order: Sequence[str | Column], limit: int) -> DataFrame:
    """At most ``limit`` rows in a fixed order, small enough for ``toPandas()``."""
    return df.orderBy(*order).limit(limit)
