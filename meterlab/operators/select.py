"""Row selection: time ranges and peaks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from meterlab.functions import known

_SLICE = "_slice"
SLICE_ROWS = 1_000_000


def _largest(df: DataFrame, by: Sequence[str]) -> int:
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def between(
    df: DataFrame, start: str | datetime, end: str | datetime, ts: str = "ts"
) -> DataFrame:
    """Rows with ``start <= ts < end``.

    The bounds are compared with the bare column, so the scan prunes row groups
    by them.
    """
    low, high = (F.lit(str(t)).cast("timestamp_ntz") for t in (start, end))
    return df.where((F.col(ts) >= low) & (F.col(ts) < high))


def peaks(
    df: DataFrame,
    by: Sequence[str] = ("date",),
    k: int = 3,
    col: str = "power_kw",
    key: str = "event_id",
    ts: str = "ts",
    slices: int | None = None,
) -> DataFrame:
    """The ``k`` highest known readings of each group, ties broken by row key.

    A group may hold any share of the rows: it is cut into slices by the row
    key, each slice keeps its ``k`` best, and those are ranked. Up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark also applies the
    limit before each shuffle. For a larger ``k`` give ``slices``, the largest
    group's rows over those that a task may sort; ``None`` counts the groups
    and takes one slice per ``SLICE_ROWS`` of the largest.
    """
    by = list(by)
    if "date" in by and "date" not in df.columns:
        df = df.withColumn("date", F.to_date(ts))
    if slices is None:
        limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
        slices = 1 if k <= limit else _largest(df, by) // SLICE_ROWS + 1
    best = [F.col(col).desc(), F.col(key).asc()]
    in_slice = Window.partitionBy(*by, _SLICE).orderBy(*best)
    in_group = Window.partitionBy(*by).orderBy(*best)
    candidates = (
        df.where(known(F.col(col), df.schema[col].dataType).isNotNull())
        .withColumn(_SLICE, F.pmod(F.xxhash64(key), F.lit(slices)))
        .withColumn("rank", F.row_number().over(in_slice))
        .where(F.col("rank") <= k)
        .drop(_SLICE, "rank")
    )
    return candidates.withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= k)
