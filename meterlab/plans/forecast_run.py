"""The complete way from stored readings to scored forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from meterlab.operators.clean import drop_missing, fill_forward, impute_stage, null_tokens
from meterlab.operators.convert import apply_schema
from meterlab.operators.evaluate import errors
from meterlab.operators.features import (
    calendar_features,
    calendar_flags,
    cyclic_features,
    history_features,
)
from meterlab.operators.grid import direct_label, regular_grid, resample
from meterlab.operators.model import forecast, split_by_time, train
from meterlab.plans.blocks import BLOCK_ROWS, settle
from meterlab.sources.readings import READINGS_SCHEMA, read_raw_text, read_readings


@dataclass
class ForecastConfig:
    """What :func:`run` does at each step; the defaults suit a table of readings."""

    cutoff: str
    # Extract and convert. ``text_columns`` marks delimited text.
    fmt: str = "parquet"
    schema: StructType = field(default_factory=lambda: READINGS_SCHEMA)
    rename: Mapping[str, str] = field(default_factory=dict)
    text_columns: Sequence[str] = ()
    sep: str = ","
    patterns: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, Any] = field(default_factory=dict)
    # Missing values: "drop", "forward" (past values only) or "impute"
    # (means of the training part, for the features alone).
    missing: str = "drop"
    # Features.
    by: Sequence[str] = ("meter_id",)
    ts: str = "ts"
    key: str = "event_id"
    value: str = "power_kw"
    label: str | Column | None = None
    # A grid of steps and how far ahead on it: the label is then the value ``horizon``
    # steps later, and ``<value>_<agg>`` of the current step is a feature.
    step: str | None = None
    horizon: int = 0
    agg: str = "mean"
    parts: Sequence[str] = ("hour", "weekday")
    flags: bool = False
    cycles: Sequence[str] = ()
    lags: Sequence[int] = (1,)
    rolling: Sequence[int] = (3,)
    stats: Sequence[str] = ("mean",)
    delta: bool = False
    block_rows: int = BLOCK_ROWS
    # Model.
    params: Mapping[str, Any] = field(default_factory=dict)
    scale: str | None = None


def extract(spark: SparkSession, path: str, config: ForecastConfig) -> DataFrame:
    """Stored readings as typed rows."""
    if not config.text_columns:
        return read_readings(
            spark, path, config.fmt, config.schema, config.rename, **dict(config.options)
        )
    raw = read_raw_text(spark, path, config.text_columns, config.sep, **dict(config.options))
    raw = null_tokens(raw, config.text_columns).withColumnsRenamed(dict(config.rename))
    return apply_schema(raw, config.schema, config.patterns)


def make_features(df: DataFrame, config: ForecastConfig) -> tuple[DataFrame, list[str]]:
    """Readings with label and features, and the names of the features.

    No feature sees its own row's value or a later one; on a grid with a horizon,
    the current step's value is known and the label lies ahead.
    """
    if config.step:
        return _grid_features(df, config)
    if config.horizon:
        raise ValueError("a horizon needs a step")
    order = [config.ts, config.key]
    label = config.value if config.label is None else config.label
    # Taken before gaps are filled: a filled value is no reading to score by.
    df = df.withColumn("label", F.col(label) if isinstance(label, str) else label)
    if config.missing == "forward":
        df = fill_forward(df, config.value, config.by, order, config.block_rows)
    elif config.missing == "drop":
        df = drop_missing(df, [config.value])
    elif config.missing != "impute":
        raise ValueError(f"unknown handling of missing values: {config.missing!r}")
    return _with_features(df, config, config.value, config.ts, order, [])


def _grid_features(df: DataFrame, config: ForecastConfig) -> tuple[DataFrame, list[str]]:
    """Steps with the label ``horizon`` steps ahead and features of what is known by then."""
    if config.horizon < 1 or config.label is not None:
        raise ValueError("on a grid the label is the value at least one step ahead")
    if config.missing == "drop":
        # Empty steps would be dropped again, and offer no label: those with readings are enough.
        df = df.where(F.col(config.ts).isNotNull())
        grid = resample(df, config.step, config.by, (config.agg,), config.value, config.ts)
    else:
        grid = regular_grid(df, config.step, config.by, (config.agg,), config.value, config.ts)
    value = f"{config.value}_{config.agg}"
    df = direct_label(grid, value, config.horizon, config.step, config.by, unique=True)
    df = df.withColumnRenamed("bucket", config.ts) if config.ts != "bucket" else df
    if config.missing == "forward":
        df = fill_forward(df, value, config.by, [config.ts], config.block_rows)
    elif config.missing == "drop":
        df = drop_missing(df, [value])
    elif config.missing != "impute":
        raise ValueError(f"unknown handling of missing values: {config.missing!r}")
    return _with_features(df, config, value, config.ts, [config.ts], [value])


def _with_features(
    df: DataFrame,
    config: ForecastConfig,
    value: str,
    ts: str,
    order: Sequence[str],
    known: Sequence[str],
) -> tuple[DataFrame, list[str]]:
    given = set(df.columns) - set(known)
    df = history_features(
        df,
        value,
        config.lags,
        config.rolling,
        config.stats,
        by=config.by,
        order=order,
        block_rows=config.block_rows,
    )
    if config.delta and not {1, 2} <= set(config.lags):
        raise ValueError("the last change needs lags 1 and 2")
    if config.delta:
        # The change up to the previous reading: the current value is the target.
        last, earlier = (F.col(f"{value}_lag_{n}") for n in (1, 2))
        df = df.withColumn(f"{value}_last_change", last - earlier)
    df = calendar_features(df, ts, config.parts)
    if config.flags:
        df = calendar_flags(df, ts).drop("day_part")
    if config.cycles:
        df = cyclic_features(df, config.cycles, ts)
    features = [c for c in df.columns if c not in given]
    return df, features


def fit_and_forecast(
    df: DataFrame, features: Sequence[str], config: ForecastConfig
) -> tuple[PipelineModel, DataFrame]:
    """The model of the training part, and its forecasts for the test part.

    Rows that lack a feature are dropped from both parts, except that
    ``missing="impute"`` fills features with the means of the training part. A label
    is needed for training only. The features are computed once and stored.
    """
    before, used, needed = [], list(features), list(features)
    if config.missing == "impute":
        numeric = [c for c in features if dict(df.dtypes)[c] in ("double", "float")]
        before = [impute_stage(numeric)]
        used = [c for c in features if c not in numeric] + [f"{c}_filled" for c in numeric]
        needed = [c for c in features if c not in numeric]
    complete = settle(drop_missing(df, needed) if needed else df, "features")
    training, test = split_by_time(complete, config.cutoff, config.ts)
    training = drop_missing(training, ["label"])
    model = train(training, used, "label", config.params, before, config.scale)
    return model, forecast(model, test)


def run(
    spark: SparkSession, path: str | DataFrame, config: ForecastConfig
) -> DataFrame:
    """Forecasts (``label``, ``prediction``) for the test part; score them with :func:`score`.

    Rows of the test part whose label is not known yet get a forecast too.
    """
    df = path if isinstance(path, DataFrame) else extract(spark, path, config)
    return fit_and_forecast(*make_features(df, config), config)[1]


def score(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors of the forecasts that :func:`run` returns."""
    return errors(predictions, "label", "prediction", by)
