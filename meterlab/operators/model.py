"""Feature vectors, splits, training and forecasts with MLlib."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any, NamedTuple

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType

from meterlab.plans.blocks import ensure_checkpoint_dir, running_total, settle

MAX_BINS = 32  # MLlib's default of ``maxBins``
# Rows of a task that trees are grown from.
CELL_ROWS = 5_000
_WEIGHT = "_weight"


class Cells(NamedTuple):
    """Fitted stages, and the rows to learn from, equal ones as one with a weight."""

    stages: list[Transformer]
    table: DataFrame


def assemble_stage(
    cols: Sequence[str], handle_invalid: str = "error", out: str = "features"
) -> VectorAssembler:
    """Stage that puts numeric columns into one vector; by default NULL is an error."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def scale_stage(
    kind: str = "standard", source: str = "features", out: str = "scaled"
) -> StandardScaler | MinMaxScaler:
    """Stage that standardises (mean 0, deviation 1) or maps to [0, 1]; trees do not need it."""
    if kind == "standard":
        return StandardScaler(inputCol=source, outputCol=out, withMean=True, withStd=True)
    if kind == "minmax":
        return MinMaxScaler(inputCol=source, outputCol=out)
    raise ValueError(f"unknown scaling: {kind!r}")


def split_by_time(
    df: DataFrame, cutoff: str | datetime, ts: str = "ts"
) -> tuple[DataFrame, DataFrame]:
    """Training part before the cutoff, test part from it on; rows without a time are in neither."""
    limit = F.lit(str(cutoff)).cast("timestamp_ntz")
    return df.where(F.col(ts) < limit), df.where(F.col(ts) >= limit)


def split_by_key(
    df: DataFrame, key: str | Sequence[str] = "event_id", share: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same rows however the data is partitioned."""
    keys = [key] if isinstance(key, str) else list(key)
    slot = F.pmod(F.xxhash64(*keys), F.lit(10_000))
    limit = round(share * 10_000)
    return df.where(slot < limit), df.where(slot >= limit)


def bin_stage(df: DataFrame, features: Sequence[str], bins: int = MAX_BINS) -> Bucketizer | None:
    """Stage that cuts features into ``bins`` bins of about equal numbers of rows, as ``_bin_<feature>``.

    Trees try no more thresholds than ``maxBins`` anyway. Cuts come from all values, counted; features
    of up to twice as many values stay as they are. None if all do.
    """
    each = F.array(*[F.struct(F.lit(i).alias("_of"), F.col(f).cast("double").alias("_value")) for i, f in enumerate(features)])
    counted = settle(df.select(F.inline(each)).groupBy("_of", "_value").agg(F.count("*").alias("_n")), "values")
    sizes = counted.groupBy("_of").agg(F.count("*").alias("distinct"), F.sum("_n").alias("_rows"))
    many = sizes.where(F.col("distinct") > 2 * bins).select("_of", "_rows")
    upto = running_total(counted.join(F.broadcast(many), "_of"), ["_of"], ["_value"], "_n", "_upto")
    # A value lies in the bin of its middle row, so a common value parts those on its two sides.
    place = F.call_function("div", (2 * F.col("_upto") - F.col("_n")) * bins, 2 * F.col("_rows"))
    starts = upto.groupBy("_of", place.alias("_bin")).agg(F.min("_value").alias("start")).collect()
    cuts = {i: sorted(r.start for r in starts if r["_of"] == i)[1:] for i in sorted({r["_of"] for r in starts})}
    if not cuts:
        return None
    return Bucketizer(
        inputCols=[features[i] for i in cuts],
        outputCols=[f"_bin_{features[i]}" for i in cuts],
        splitsArray=[[-math.inf, *c, math.inf] for c in cuts.values()],
    )


def _may_merge(df: DataFrame, features: Sequence[str], settings: Mapping[str, Any]) -> bool:
    """Whether rows of equal features may learn as one: not if rows are drawn, counted or weighed one by one."""
    plain = {"subsamplingRate": 1.0, "lossType": "squared", "minInstancesPerNode": 1, "weightCol": None}
    numbers = all(isinstance(df.schema[f].dataType, (NumericType, BooleanType)) for f in features)
    return numbers and all(settings.get(name, value) == value for name, value in plain.items())


def cells(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    bins: int = MAX_BINS,
    before: Sequence[Estimator | Transformer] = (),
    scale: str | None = None,
    validation: str | None = None,
) -> Cells:
    """Rows whose features lie in equal bins, as one row with their mean label and their number as weight.

    With squared loss such rows give the same trees as the single ones: all trees treat them alike, so
    only the mean of their labels counts. Rows of the validation part keep their labels, since their
    error counts. Sums of labels are of whole numbers, so they do not depend on the order of rows.
    """
    fitted = list(Pipeline(stages=list(before)).fit(df).stages) if before else []
    df = PipelineModel(stages=fitted).transform(df) if fitted else df
    learnt = df if validation is None else df.where(~F.col(validation))
    binned = bin_stage(learnt, features, bins)
    names = {} if binned is None else dict(zip(binned.getInputCols(), binned.getOutputCols(), strict=True))
    if binned is not None:
        fitted.append(binned)
        df = binned.transform(df)
    used = [names.get(f, f) for f in features]
    fitted.append(assemble_stage(used))
    if scale is not None:
        fitted.append(scale_stage(scale).fit(fitted[-1].transform(df)))
    value = F.col(label).cast("double")
    top = df.agg(F.max(F.abs(value))).first()[0] or 1.0
    unit = 2.0 ** max(math.frexp(top)[1] - 60, -1_000)
    whole = F.sum(F.round(value / unit).cast("bigint").cast("decimal(20,0)")).cast("double")
    mean = (whole / F.count("*") * unit).alias(label)
    weight = F.count("*").cast("double").alias(_WEIGHT)
    keys = list(dict.fromkeys(used))
    if validation is None:
        return Cells(fitted, df.groupBy(*keys).agg(mean, weight))
    merged = df.where(~F.col(validation)).groupBy(*keys).agg(mean, weight).withColumn(validation, F.lit(False))
    kept = df.where(validation).groupBy(*keys, value.alias(label)).agg(weight).withColumn(validation, F.lit(True))
    return Cells(fitted, merged.unionByName(kept))


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    params: Mapping[str, Any] | None = None,
    before: Sequence[Estimator | Transformer] = (),
    scale: str | None = None,
    persist: bool = True,
    validation: str | None = None,
    merged: Cells | None = None,
) -> PipelineModel:
    """Fit a gradient-boosted-tree regression.

    ``validation`` names a boolean column: rows with true are not learnt from, and boosting stops
    when the error on them falls no more (``validationTol`` in ``params``), however many trees ``maxIter`` allows.

    ``before`` holds stages to fit first, such as an imputer whose output is
    among ``features``. Boosting reads its input some hundred times, so it reads :func:`cells`,
    whose number is bounded by the bins and not by the rows; several fits may share them as
    ``merged``. Where single rows matter (``subsamplingRate``, ``minInstancesPerNode``, ``weightCol``, another
    loss) it reads these. The table that it reads is kept while it runs; the tree updates cut their
    lineage in the checkpoint folder. It is dealt and sorted by its values first, so equal
    rows give an equal model, however they lay in files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    settings = {"seed": 42, "maxIter": 20, "maxDepth": 5, "maxMemoryInMB": 512}
    settings.update(params or {})
    if validation is not None:
        settings["validationIndicatorCol"] = validation
    made = {c for stage in before for c in stage.getOutputCols()}
    read = {c for stage in before for c in stage.getInputCols()}
    needed = sorted((set(features) - made) | read | {label} | ({validation} if validation else set()))
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        if persist:
            kept.append(table.persist(StorageLevel.MEMORY_AND_DISK))
        return table

    def dealt(table: DataFrame, parts: int) -> DataFrame:
        return keep(table.repartition(parts, *table.columns).sortWithinPartitions(*table.columns))

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vector = "features" if scale is None else "scaled"
    try:
        if not _may_merge(df, [f for f in features if f not in made], settings):
            stages = [*before, assemble_stage(features), *([] if scale is None else [scale_stage(scale)])]
            stages.append(GBTRegressor(featuresCol=vector, labelCol=label, **settings))
            return Pipeline(stages=stages).fit(dealt(df.select(*needed), parts))
        if merged is None:
            table = keep(df.select(*needed))
            merged = cells(table, features, label, settings.get("maxBins", MAX_BINS), before, scale, validation)
        table = keep(merged.table)
        rows = dealt(table, min(parts, table.count() // CELL_ROWS + 1))
        boosting = GBTRegressor(featuresCol=vector, labelCol=label, **(settings | {"weightCol": _WEIGHT}))
        # The rows are imputed and binned; vectors are still to be made, and scaled.
        ready = PipelineModel(stages=merged.stages[-1:] if scale is None else merged.stages[-2:])
        return PipelineModel(stages=[*merged.stages, boosting.fit(ready.transform(rows))])
    finally:
        for table in kept:
            table.unpersist()


def forecast(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``; the columns that the model made on the way are dropped.

    With features of earlier readings this is a forecast one step ahead.
    """
    bins = [c for stage in model.stages if isinstance(stage, Bucketizer) for c in stage.getOutputCols()]
    made = [c for c in ("features", "scaled", *bins) if c not in df.columns]
    return model.transform(df).drop(*made)


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    """Store a fitted model on any Hadoop path."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> PipelineModel:
    """Load a model stored by :func:`save_model`."""
    return PipelineModel.load(path)
