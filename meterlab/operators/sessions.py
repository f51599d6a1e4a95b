"""Runs of readings, and the gaps between them: outages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from meterlab.functions import known, micros, width_micros
from meterlab.plans.blocks import BLOCK_ROWS, over_ordered, running_total

_SECOND = 1_000_000


def _gaps(df: DataFrame, col: str | None, longest: str, by, ts, block_rows, split) -> DataFrame:
    """The times of known readings, how many each has, the time before, and whether a gap above ``longest`` lies between."""
    held = df.where(F.col(ts).isNotNull())
    if col is not None:
        held = held.where(known(F.col(col), df.schema[col].dataType).isNotNull())

    instants = held.groupBy(*by, ts).agg(F.count("*").alias("n_readings"))

    def before(series):
        return {"_before": F.lag(ts, 1).over(series)}

    looked = over_ordered(instants, by, [ts], before, 1, [ts], None, block_rows, split)
    apart = micros(F.col(ts)) - micros(F.col("_before"))
    return looked.withColumn("_apart", apart).withColumn("_gap", F.col("_apart") > width_micros(longest))


def outages(
    df: DataFrame,
    longest: str = "6 hours",
    col: str | None = "power_kw",
    by: Sequence[str] = ("meter_id",),
    ts: str = "ts",
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """One row per time in which a key had no known reading for more than ``longest``.

    ``outage_start`` is the last reading before, ``outage_end`` the first after, ``seconds`` the whole seconds
    between. Times before the first and after the last reading are no outages. With ``col=None`` a row
    counts as a reading whatever its value.
    """
    gaps = _gaps(df, col, longest, list(by), ts, block_rows, split).where("_gap")
    seconds = F.call_function("div", F.col("_apart"), F.lit(_SECOND))
    return gaps.select(
        *by, F.col("_before").alias("outage_start"), F.col(ts).alias("outage_end"), seconds.alias("seconds")
    )


def sessions(
    df: DataFrame,
    longest: str = "6 hours",
    col: str | None = "power_kw",
    by: Sequence[str] = ("meter_id",),
    ts: str = "ts",
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """One row per run of known readings that are no more than ``longest`` apart.

    ``session`` numbers the runs of a key from 0, ``session_start`` and ``session_end`` are its first and last
    reading, ``n_readings`` counts them. Numbers come from running totals over blocks, and a run that crosses
    blocks is put together by a pre-aggregated grouping, so neither a long series nor a long run meets in one task.
    """
    by = list(by)
    marked = _gaps(df, col, longest, by, ts, block_rows, split)
    begins = F.coalesce(F.col("_gap"), F.lit(False)).cast("bigint")
    numbered = running_total(marked.withColumn("_begins", begins), by, [ts], "_begins", "session", block_rows, split)
    return numbered.groupBy(*by, "session").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.sum("n_readings").alias("n_readings")
    )
