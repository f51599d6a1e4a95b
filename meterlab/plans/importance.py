"""Permutation importance: what a forecast loses if one feature is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window, functions as F

from meterlab.operators.evaluate import errors
from meterlab.operators.model import forecast
from meterlab.plans.blocks import settle

# Rows that trade their features among themselves; more make no better shuffle.
GROUP_ROWS = 10_000


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    key: Sequence[str] = ("event_id",),
    repeats: int = 1,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(feature, rmse, loss): the RMSE with the feature shuffled, and by how much it exceeds the true one.

    Rows are dealt by a hash of ``key`` to groups of about ``group_rows`` and sorted in them by another; each takes
    the features of the next row, the last those of the first. All features are shuffled in
    this one go, and every row is scored once as it is and once per feature, in one pass without another
    shuffle. ``repeats`` other shuffles are averaged. Rows without the label do not count. Features of one
    value for all rows lose nothing, and of two that say the same neither loses much.
    """
    features, keys = list(features), list(key)
    rows = settle(df.where(F.col(label).isNotNull()).select(*dict.fromkeys([*keys, label, *features])), "scored-rows")
    groups = rows.count() // group_rows + 1
    shuffled = rows
    for r in range(repeats):
        deal = F.pmod(F.xxhash64(F.lit(2 * r), *keys), F.lit(groups))
        lot = F.xxhash64(F.lit(2 * r + 1), *keys)
        ring = Window.partitionBy(deal).orderBy(lot, *keys)
        whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        given = F.struct(*[F.col(f).alias(f) for f in features])
        next_ = F.coalesce(F.lead(given, 1).over(ring), F.first(given).over(whole))
        shuffled = shuffled.withColumn(f"_given_{r}", next_)
    # One row as it is, and one for each feature and shuffle.
    types = dict(rows.dtypes)
    as_is = F.struct(F.lit(None).cast("string").alias("_feature"), F.lit(0).alias("_repeat"), *[F.col(f).alias(f) for f in features])
    versions = [as_is] + [
        F.struct(
            F.lit(f).alias("_feature"),
            F.lit(r).alias("_repeat"),
            *[(F.col(f"_given_{r}")[g] if g == f else F.col(g)).cast(types[g]).alias(g) for g in features],
        )
        for r in range(repeats)
        for f in features
    ]
    kept = [c for c in dict.fromkeys([*keys, label]) if c not in features]
    unfolded = shuffled.select(*kept, F.inline(F.array(*versions)))
    scored = errors(forecast(model, unfolded), label, "prediction", ["_feature", "_repeat"])
    # One row per feature and shuffle.
    table = settle(scored, "scores")
    base = table.where("_feature is null").select(F.col("rmse").alias("_base"))
    means = table.where("_feature is not null").groupBy(F.col("_feature").alias("feature")).agg(F.avg("rmse").alias("rmse"))
    true = base.first()
    return means.withColumn("loss", F.col("rmse") - F.lit(true["_base"] if true else None).cast("double"))
