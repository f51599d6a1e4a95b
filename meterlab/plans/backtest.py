"""Rolling-origin backtests: one stored feature table, a model per cutoff, folds side by side."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F

from meterlab.functions import from_micros, is_fixed_width, micros, months, width_micros
from meterlab.operators.clean import drop_missing
from meterlab.operators.evaluate import errors
from meterlab.operators.model import forecast, train
from meterlab.plans.blocks import settle
from meterlab.plans.forecast_run import ForecastConfig, make_features


def _later(ts: Column, step: str, times: int) -> Column:
    if is_fixed_width(step):
        return from_micros(micros(ts) + times * width_micros(step))
    return F.add_months(ts.cast("date"), times * months(step)).cast("timestamp_ntz")


def folds(
    df: DataFrame, cutoffs: Sequence[str | datetime], width: str, config: ForecastConfig
) -> list[tuple[DataFrame, DataFrame]]:
    """Training and test part of each cutoff.

    A row is trained on if its label is known before the cutoff: with a ``horizon`` that is
    so many steps after the row's own time. The test part is ``[cutoff, cutoff + width)``.
    """
    ts = F.col(config.ts)
    told_at = _later(ts, config.step, config.horizon) if config.step else ts
    parts = []
    for cutoff in cutoffs:
        start = F.lit(str(cutoff)).cast("timestamp_ntz")
        training = drop_missing(df.where(told_at < start), ["label"])
        test = df.where((ts >= start) & (ts < _later(start, width, 1)))
        parts.append((training, test))
    return parts


def backtest(
    df: DataFrame,
    config: ForecastConfig,
    cutoffs: Sequence[str | datetime],
    width: str = "1 day",
    at_once: int = 4,
) -> DataFrame:
    """Forecasts of all folds, each row with its ``cutoff``, ``label`` and ``prediction``.

    Features are computed once, for all folds, and stored; that is sound as none looks at later rows. Folds
    are trained ``at_once``, since boosting runs many short jobs that leave a cluster idle. Trees,
    features and missing values are as in ``config``, whose own cutoff is not used. ``impute`` would learn from
    all rows, so it is refused. A fold without any row to learn from gives no forecasts.
    """
    if config.missing == "impute":
        raise ValueError("impute learns from a training part; use drop or forward")
    if not cutoffs:
        raise ValueError("no cutoffs")
    table, features = make_features(df, config)
    stored = settle(drop_missing(table, list(features)), "backtest-features")

    def one(fold: tuple[str | datetime, tuple[DataFrame, DataFrame]]) -> DataFrame:
        cutoff, (training, test) = fold
        at = F.lit(str(cutoff)).cast("timestamp_ntz").alias("cutoff")
        if training.isEmpty():
            return test.limit(0).select(at, "*", F.lit(None).cast("double").alias("prediction"))
        model = train(training, features, "label", config.params, scale=config.scale)
        return forecast(model, test).select(at, "*")

    parts = zip(cutoffs, folds(stored, cutoffs, width, config), strict=True)
    target = inheritable_thread_target(df.sparkSession)(one)
    with ThreadPoolExecutor(at_once) as pool:
        return reduce(DataFrame.unionByName, list(pool.map(target, parts)))


def backtest_errors(forecasts: DataFrame, by: Sequence[str] = ("cutoff",)) -> DataFrame:
    """Errors of each fold."""
    return errors(forecasts, "label", "prediction", by)
