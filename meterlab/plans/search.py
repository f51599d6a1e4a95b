"""Search for the parameters of a model on the latest part of the training data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from meterlab.operators.clean import drop_missing
from meterlab.operators.evaluate import rmse
from meterlab.operators.model import MAX_BINS, Cells, cells, forecast, train
from meterlab.plans.blocks import settle


def _stored(merged: Cells) -> Cells:
    return merged._replace(table=settle(merged.table, "search-cells"))


def search(
    df: DataFrame,
    features: Sequence[str],
    candidates: Sequence[Mapping[str, Any]],
    cutoff: str | datetime,
    label: str = "label",
    ts: str = "ts",
    at_once: int = 4,
) -> tuple[PipelineModel, list[dict[str, Any]]]:
    """The best model, and for each candidate its ``params``, ``rmse`` and number of ``trees``, best first.

    Candidates learn from the rows before ``cutoff`` and are compared on those from it on, which also tell when
    to stop boosting; so no fit sees a later row, as a random split would. ``df`` is the training
    part of a later test. Fits run ``at_once`` over one stored table. Ties go to the earlier candidate.
    """
    if not candidates:
        raise ValueError("no candidates")
    later = F.col(ts) >= F.lit(str(cutoff)).cast("timestamp_ntz")
    known = drop_missing(df, [*features, label, ts]).withColumn("_later", later)
    table = settle(known.select(*dict.fromkeys([*features, label]), "_later"), "search-rows")
    if table.where(~F.col("_later")).isEmpty() or table.where("_later").isEmpty():
        raise ValueError("the cutoff leaves one part empty")

    # Equal rows are merged once for all fits with as many bins.
    merged = {
        bins: _stored(cells(table, features, label, bins, validation="_later"))
        for bins in {p.get("maxBins", MAX_BINS) for p in candidates}
    }

    def one(params: Mapping[str, Any]) -> tuple[PipelineModel, float]:
        shared = merged[params.get("maxBins", MAX_BINS)]
        model = train(table, features, label, params, validation="_later", merged=shared)
        return model, rmse(forecast(model, table.where("_later")), label).first()["rmse"]

    target = inheritable_thread_target(df.sparkSession)(one)
    with ThreadPoolExecutor(at_once) as pool:
        fits = list(pool.map(target, candidates))
    order = sorted(range(len(fits)), key=lambda i: fits[i][1])
    told = [
        {"params": dict(candidates[i]), "rmse": fits[i][1], "trees": fits[i][0].stages[-1].getNumTrees} for i in order
    ]
    return fits[order[0]][0], told
