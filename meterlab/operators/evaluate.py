"""Forecast errors, and naive forecasts to measure a model against."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from meterlab.functions import mean
from meterlab.operators.features import lag_features
from meterlab.operators.grid import seasonal_lag
from meterlab.operators.weighted import ewm_features
from meterlab.plans.blocks import BLOCK_ROWS, attach


def rmse(
    df: DataFrame, label: str = "label", pred: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Root mean square error over the rows that have both values."""
    miss = F.col(pred) - F.col(label)
    return df.groupBy(*by).agg(
        F.count(miss).alias("n"), F.sqrt(F.avg(miss * miss)).alias("rmse")
    )


def errors(
    df: DataFrame, label: str = "label", pred: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """RMSE, MAE, mean bias and R2 in one pass, over the rows that have both values."""
    miss = F.col(pred) - F.col(label)
    seen = F.when(miss.isNotNull(), F.col(label))
    unexplained = F.try_divide(F.avg(miss * miss), F.var_pop(seen))
    return df.groupBy(*by).agg(
        F.count(miss).alias("n"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        F.avg(miss).alias("bias"),
        (F.lit(1.0) - unexplained).alias("r2"),
    )


def naive_forecast(
    df: DataFrame,
    kind: str,
    col: str = "power_kw",
    by: Sequence[str] = ("meter_id",),
    ts: str = "ts",
    order: Sequence[str] | None = None,
    cutoff: str | datetime | None = None,
    period: str = "24 hours",
    scale: int | None = None,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
    unique: bool = False,
) -> DataFrame:
    """Add ``forecast``: ``"mean"`` of the key before ``cutoff``, ``"last"`` reading, the ``"season"``
    value one period earlier (on a grid, which is ``unique``), or the ``"smooth"`` mean of all earlier
    readings, whose weights halve with every ``period``."""
    by = list(by)
    if kind == "last":
        lagged = lag_features(
            df, col, (1,), by, order or (ts,), block_rows=block_rows, split=split
        )
        return lagged.withColumnRenamed(f"{col}_lag_1", "forecast")
    if kind == "season":
        return seasonal_lag(df, col, period, by, ts, out="forecast", unique=unique)
    if kind == "smooth":
        return ewm_features(
            df, col, period, by, order or (ts,), "forecast", block_rows=block_rows, split=split
        )
    if kind == "mean":
        if cutoff is None:
            raise ValueError("the mean forecast needs the cutoff that ends the training part")
        past = df.where(F.col(ts) < F.lit(str(cutoff)).cast("timestamp_ntz"))
        if not by:
            return df.withColumn("forecast", past.agg(mean(F.col(col), scale)).scalar())
        return attach(df, by, mean(F.col(col), scale).alias("forecast"), of=past)
    raise ValueError(f"unknown naive forecast: {kind!r}")
