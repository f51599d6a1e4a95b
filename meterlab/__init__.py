"""Meter readings at scale on Spark: clean, convert, explore, forecast."""

from meterlab.operators import *  # noqa: F403
from meterlab.operators import __all__ as _operators
from meterlab.plans.backtest import backtest, backtest_errors
from meterlab.plans.forecast_run import ForecastConfig, run, score
from meterlab.plans.importance import permutation_importance
from meterlab.plans.recursive import recursive_forecast
from meterlab.plans.search import search
from meterlab.sources import (
    READINGS_SCHEMA,
    merge_readings,
    query,
    read_raw_text,
    read_readings,
    refresh_features,
    register,
    write_table,
)

__all__ = [
    *_operators,
    "READINGS_SCHEMA",
    "ForecastConfig",
    "backtest",
    "backtest_errors",
    "merge_readings",
    "permutation_importance",
    "query",
    "read_raw_text",
    "read_readings",
    "recursive_forecast",
    "refresh_features",
    "register",
    "run",
    "score",
    "search",
    "write_table",
]
