"""Regular steps: resampling, grids, and values at a fixed distance in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.functions import (
    bucket,
    from_micros,
    is_fixed_width,
    known,
    mean,
    micros,
    months,
    total,
    width_micros,
)
from meterlab.plans.blocks import join_on, over_ordered, settle

STEP_STATS = ("sum", "mean", "min", "max")
_CHUNK = 10_000
_STEPS_PER_TASK = 1_000_000


def _step_statistics(
    df: DataFrame, col: str, aggs: Sequence[str], scale: int | None
) -> list[Column]:
    value = known(F.col(col), df.schema[col].dataType)
    how = {
        "sum": total(value, scale),
        "mean": mean(value, scale),
        "min": F.min(value),
        "max": F.max(value),
    }
    return [how[a].alias(f"{col}_{a}") for a in aggs]


def resample(
    df: DataFrame,
    step: str = "hour",
    by: Sequence[str] = ("meter_id",),
    aggs: Sequence[str] = STEP_STATS,
    col: str = "power_kw",
    ts: str = "ts",
    scale: int | None = None,
) -> DataFrame:
    """One row per key and step that has readings: ``bucket``, ``n_readings``, ``<col>_<agg>``."""
    return df.groupBy(*by, bucket(F.col(ts), step).alias("bucket")).agg(
        F.count("*").alias("n_readings"), *_step_statistics(df, col, aggs, scale)
    )


def _steps_apart(earlier: Column, later: Column, step: str) -> Column:
    """How many steps lie between two starts of steps."""
    if is_fixed_width(step):
        return F.call_function("div", micros(later) - micros(earlier), F.lit(width_micros(step)))
    passed = (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    return F.call_function("div", passed.cast("bigint"), F.lit(months(step)))


def _empty_steps(gaps: DataFrame, step: str, by: Sequence[str]) -> DataFrame:
    """The ``_missing`` steps that follow ``_before``.

    A long gap has more steps than one array or one task should hold: it is cut
    into chunks, and these are spread over as many tasks as the steps need. Chunks
    are few bytes for many steps, so the number of tasks is given.
    """
    total = gaps.agg(F.sum("_missing")).first()[0] or 0
    last_chunk = F.call_function("div", F.col("_missing") - 1, F.lit(_CHUNK))
    chunks = gaps.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    if total > _STEPS_PER_TASK:
        chunks = chunks.repartition(total // _STEPS_PER_TASK + 1, *by, "_before", "_chunk")
    start = F.col("_chunk") * _CHUNK + 1
    number = F.explode(F.sequence(start, F.least(start + _CHUNK - 1, F.col("_missing"))))
    numbered = chunks.select(*by, "_before", number.alias("_number"))
    if is_fixed_width(step):
        at = from_micros(micros(F.col("_before")) + F.col("_number") * width_micros(step))
    else:
        passed = (F.col("_number") * months(step)).cast("int")
        at = F.add_months(F.col("_before").cast("date"), passed).cast("timestamp_ntz")
    return numbered.select(*by, at.alias("bucket"))


def regular_grid(
    df: DataFrame,
    step: str = "hour",
    by: Sequence[str] = ("meter_id",),
    aggs: Sequence[str] = STEP_STATS,
    col: str = "power_kw",
    ts: str = "ts",
    scale: int | None = None,
) -> DataFrame:
    """One row per key and step from its first to its last reading; empty steps hold NULL.

    Readings are gathered by step first. Each step with readings then looks at the
    one before it and makes the empty steps between the two, so these pass through
    no shuffle, and the readings are read once. Readings without a time belong to no
    step.
    """
    by = list(by)
    timed = df.where(F.col(ts).isNotNull())
    steps = settle(resample(timed, step, by, aggs, col, ts, scale), "steps")
    looked = over_ordered(
        steps.select(*by, "bucket"),
        by,
        ["bucket"],
        lambda series: {"_before": F.lag("bucket", 1).over(series)},
        reach=1,
        cols=["bucket"],
    )
    missing = _steps_apart(F.col("_before"), F.col("bucket"), step) - 1
    gaps = settle(
        looked.withColumn("_missing", missing).where("_missing > 0").drop("bucket"), "gaps"
    )
    empty = _empty_steps(gaps, step, by).withColumn("n_readings", F.lit(0).cast("bigint"))
    return steps.unionByName(empty, allowMissingColumns=True)


def _moved(ts: Column, step: str, times: int) -> Column:
    """The time so many steps later (or earlier); calendar steps keep day and clock.

    A day that the month does not have becomes its last day.
    """
    if is_fixed_width(step):
        return from_micros(micros(ts) + times * width_micros(step))
    date = ts.cast("date")
    since_midnight = micros(ts) - micros(date.cast("timestamp_ntz"))
    return from_micros(
        micros(F.add_months(date, times * months(step)).cast("timestamp_ntz")) + since_midnight
    )


def _value_at(
    df: DataFrame, col: str, step: str, times: int, by: Sequence[str], ts: str, out: str, unique: bool
) -> DataFrame:
    """Value of the same key ``times`` steps away, for rows equal in (key, time).

    Each known value is offered to the time it is wanted at. Empty steps offer
    nothing, so a sparse grid costs few offers.
    """
    by = list(by)
    wanted_at = _moved(F.col(ts), step, -times)
    offered = F.col(ts).isNotNull() & F.col(col).isNotNull()
    if not unique:
        offers = df.where(offered).select(*by, wanted_at.alias(ts), F.col(col))
        means = offers.groupBy(*by, ts).agg(F.avg(col).alias(out))
        return join_on(df, means, [*by, ts]).select(*df.columns, out)
    # Rows and offers meet in one shuffle, and the input is evaluated once. A
    # group holds one row and one offer, whatever the distribution of keys.
    both = F.array(
        F.struct(F.lit(True).alias("_row"), F.col(ts).alias("_at")),
        F.struct(F.lit(False).alias("_row"), wanted_at.alias("_at")),
    )
    unfolded = df.select("*", F.inline(both)).where(F.col("_row") | offered)
    payload = [c for c in df.columns if c not in (*by, col)]
    narrow = unfolded.withColumns({c: F.when(F.col("_row"), F.col(c)) for c in payload})
    offer = F.when(~F.col("_row"), F.col(col))
    # Rows without a time meet no offer; they are dealt by what they hold, not to one task.
    alone = F.when(F.col("_at").isNull(), F.xxhash64(F.col(col), *payload))
    met = narrow.withColumn("_alone", alone).withColumn(
        out, F.avg(offer).over(Window.partitionBy(*by, "_at", "_alone"))
    )
    return met.where(F.col("_row")).select(*df.columns, out)


def seasonal_lag(
    df: DataFrame,
    col: str = "power_kw",
    period: str = "24 hours",
    by: Sequence[str] = ("meter_id",),
    ts: str = "ts",
    out: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """``<col>_<period>_ago``: the value exactly one period earlier, else NULL.

    The time is part of the key, so even one meter spreads over the cluster.
    ``unique=True`` promises at most one row per key and time, as grids have,
    and saves a join. Without it readings at equal times count with their mean,
    and any number of them is allowed. Every input row comes out once. The period may
    be a month, quarter or year; a value is then offered to the same day and clock one
    period later, or to the last day of a month that is shorter.
    """
    name = out or f"{col}_{'_'.join(period.split())}_ago"
    return _value_at(df, col, period, -1, by, ts, name, unique)


def direct_label(
    df: DataFrame,
    col: str,
    h: int,
    step: str = "hour",
    by: Sequence[str] = ("meter_id",),
    ts: str = "bucket",
    out: str = "label",
    unique: bool = False,
) -> DataFrame:
    """The value h steps later on a regular grid: the label of a forecast h steps ahead.

    Steps may be months, quarters or years.

    ``unique`` is as in :func:`seasonal_lag`.
    """
    return _value_at(df, col, step, h, by, ts, out, unique)
