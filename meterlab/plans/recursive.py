"""Forecasts several steps ahead with one model, each step fed by the forecasts before it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.functions import known
from meterlab.operators.features import calendar_features, calendar_flags, cyclic_features
from meterlab.operators.grid import _moved
from meterlab.operators.model import forecast
from meterlab.plans.blocks import ROWS, settle

_PAST, _LAST = "_past", "_last"
# Steps whose plans are nested before a table is written.
_NESTED = 4


def last_values(
    df: DataFrame, col: str, reach: int, by: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: the time of its last row, and its last ``reach`` values, oldest first.

    Only the last rows of each key pass the limit before the shuffle, so a long series costs its key
    no more than a short one.
    """
    by, order = list(by), list(order)
    newest = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    placed = df.where(F.col(order[0]).isNotNull()).withColumn("_age", F.row_number().over(newest))
    recent = placed.where(F.col("_age") <= reach)
    value = known(F.col(col), df.schema[col].dataType).cast("double")
    # A missing value keeps its place, which collect_list alone would close.
    item = F.struct((-F.col("_age")).alias("place"), value.alias("value"))
    return recent.groupBy(*by).agg(
        F.max(order[0]).alias(_LAST),
        F.transform(F.sort_array(F.collect_list(item)), lambda x: x["value"]).alias(_PAST),
        F.count("*").alias(ROWS),
    )


def _features(
    state: DataFrame,
    col: str,
    lags: Sequence[int],
    rolling: Sequence[int],
    stats: Sequence[str],
) -> dict[str, Column]:
    """Lags and trailing statistics of the next step, named as those of readings."""
    past = F.col(_PAST)
    columns = {f"{col}_lag_{n}": F.when(F.size(past) >= n, F.try_element_at(past, F.lit(-n))) for n in lags}
    for n in rolling:
        last = F.filter(F.slice(past, F.greatest(F.size(past) - n, F.lit(0)) + 1, n), lambda x: x.isNotNull())
        count = F.size(last)
        total = F.aggregate(last, F.lit(0.0), lambda a, x: a + x)
        mean = F.try_divide(total, count)
        spread = F.aggregate(last, F.lit(0.0), lambda a, x: a + x * x)
        how = {
            "count": count.cast("bigint"),
            "sum": F.when(count > 0, total),
            "mean": mean,
            "std": F.when(count > 1, F.sqrt(F.greatest(spread - total * mean, F.lit(0.0)) / (count - 1))),
            "min": F.array_min(last),
            "max": F.array_max(last),
        }
        columns |= {f"{col}_roll_{n}_{s}": how[s] for s in stats}
    return columns


def recursive_forecast(
    model: PipelineModel,
    df: DataFrame,
    h: int,
    step: str = "hour",
    col: str = "power_kw",
    lags: Sequence[int] = (1,),
    rolling: Sequence[int] = (),
    stats: Sequence[str] = ("mean",),
    parts: Sequence[str] = (),
    flags: bool = False,
    cycles: Sequence[str] = (),
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Forecasts for the ``h`` steps after the last row of each key: (*by, time, ``step_ahead``, ``prediction``).

    ``df`` holds one row per key and step, as grids do; ``model`` forecasts a step from these features. Each
    forecast enters the lags and trailing statistics of the next step. The state of a key is its last
    values, as many as the features reach back, so a step costs one row per key whatever the length of the series. A
    step that lacks a feature has no forecast, and those after it that need that one neither.
    """
    if h < 1:
        raise ValueError("at least one step")
    if not lags and not rolling:
        raise ValueError("without lags or trailing statistics there is nothing to feed back")
    by, order = list(by), list(order)
    ts, reach = order[0], max([*lags, *rolling])
    state = settle(last_values(df, col, reach, by, order), "forecast-state")
    made = []
    for number in range(1, h + 1):
        at = state.withColumn(ts, _moved(F.col(_LAST), step, 1)).withColumns(
            _features(state, col, lags, rolling, stats)
        )
        if parts:
            at = calendar_features(at, ts, parts)
        if flags:
            at = calendar_flags(at, ts).drop("day_part")
        if cycles:
            at = cyclic_features(at, cycles, ts)
        used = [c for c in at.columns if c not in (*state.columns, ts)]
        complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in used])
        zero = {c: F.coalesce(F.col(c), F.lit(0).cast(t)) for c, t in at.dtypes if c in used}
        told = forecast(model, at.withColumn("_complete", complete).withColumns(zero))
        told = told.withColumn("prediction", F.when(F.col("_complete"), F.col("prediction")))
        # The oldest value goes, the forecast comes.
        past = F.slice(F.concat(_PAST, F.array("prediction")), F.greatest(F.size(_PAST) + 2 - reach, F.lit(1)), reach)
        state = told.select(*by, F.col(ts).alias(_LAST), past.alias(_PAST), ROWS, "prediction")
        if number % _NESTED == 0 or number == h:
            state = settle(state, f"forecast-{number}")
        made.append(state.select(*by, F.col(_LAST).alias(ts), F.lit(number).alias("step_ahead"), "prediction"))
        state = state.drop("prediction")
    return reduce(DataFrame.unionByName, made)
