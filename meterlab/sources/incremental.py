"""Merging late and corrected readings into a stored table, and features into theirs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from meterlab.plans.blocks import BROADCAST_ROWS, join_on, settle


def _overwrite_dates(df: DataFrame, path: str, sort_by: Sequence[str]) -> None:
    """Replace the dates that ``df`` has, and no other."""
    out = df.hint("rebalance", F.col("date"))
    if sort_by:
        out = out.sortWithinPartitions("date", *sort_by)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def merge_readings(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: Sequence[str] = ("event_id",),
    version: Sequence[str] = (),
    ts: str = "ts",
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Put ``new`` rows into the table at ``path`` (as :func:`write_table` makes it), and return the touched dates.

    A new row replaces a stored one of the same ``key`` and date; of several new ones the last by ``version`` counts,
    and of stored and new ones with it that of the greater version, a new one at a tie. Only the dates that ``new``
    has are read and overwritten; files of other dates keep their names. The merged dates are stored apart before
    the table is touched, so a job that fails up to then leaves it as it was. A row whose key moves to another date
    is a new row there: corrections must keep the date. Rows without a time are refused.
    """
    key, fresh = list(key), new.withColumn("date", F.to_date(ts))
    if not fresh.where(F.col("date").isNull()).isEmpty():
        raise ValueError(f"rows without {ts} belong to no date")
    fresh = settle(fresh, "new-readings")
    dates = [r["date"] for r in fresh.select("date").distinct().orderBy("date").collect()]
    if not dates:
        return fresh.select("date")
    stored = spark.read.parquet(path).where(F.col("date").isin(dates))
    names = [c for c in stored.columns if c != "date"]
    both = stored.select(*names, "date", F.lit(0).alias("_new")).unionByName(fresh.select(*names, "date", F.lit(1).alias("_new")))
    latest = Window.partitionBy("date", *key).orderBy(*[F.col(c).desc() for c in [*version, "_new"]], *[F.col(c).desc() for c in names])
    merged = both.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank", "_new")
    _overwrite_dates(settle(merged, "merged-dates"), path, sort_by)
    return fresh.select("date").distinct()


def refresh_features(
    spark: SparkSession,
    readings: DataFrame,
    path: str,
    changed: DataFrame,
    make: Callable[[DataFrame], DataFrame],
    reach: int,
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """Recompute the stored features of ``changed`` keys from their first change on; returns the rewritten dates.

    ``make`` adds the features to readings and looks back ``reach`` rows at most, so it gets, for each key that changed,
    the rows from its first change (the least time in ``changed``) on and the ``reach`` ones before. Rows of the touched dates that are not
    recomputed stay as they were. ``readings`` is the merged table.
    """
    by, order = list(by), list(order)
    ts = order[0]
    first = settle(changed.groupBy(*by).agg(F.min(ts).alias("_first")), "first-changes")
    first = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    rows = join_on(readings, first, by, "inner")
    newest = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    earlier = rows.where(F.col(ts) < F.col("_first")).withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= reach)
    late = rows.where(F.col(ts) >= F.col("_first"))
    made = make(late.withColumn("_late", F.lit(True)).unionByName(earlier.drop("_age").withColumn("_late", F.lit(False))).drop("_first"))
    made = settle(made.where("_late").drop("_late").withColumn("date", F.to_date(ts)), "made-features")
    dates = [r["date"] for r in made.select("date").distinct().orderBy("date").collect()]
    if not dates:
        return made.select("date")
    stored = spark.read.parquet(path).where(F.col("date").isin(dates))
    kept = join_on(stored, first, by, "left").where(F.col("_first").isNull() | (F.col(ts) < F.col("_first"))).drop("_first")
    _overwrite_dates(settle(kept.unionByName(made.select(*kept.columns)), "refreshed"), path, order)
    return made.select("date").distinct()
