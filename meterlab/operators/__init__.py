"""Operators: plain functions from DataFrame to DataFrame, for ``df.transform`` or direct use."""

from meterlab.operators.asof import asof_join
from meterlab.operators.change import change_points, decompose
from meterlab.operators.clean import (
    MISSING_TOKENS,
    drop_missing,
    fill_constant,
    fill_forward,
    fill_mean,
    impute_stage,
    null_profile,
    null_tokens,
)
from meterlab.operators.convert import apply_schema, conversion_report, to_number, to_ts
from meterlab.operators.evaluate import errors, naive_forecast, rmse
from meterlab.operators.explore import (
    correlations,
    exact_quantiles,
    histogram,
    load_profile,
    plot_table,
    share,
    summarise,
    trend,
)
from meterlab.operators.features import (
    calendar_features,
    calendar_flags,
    cyclic_features,
    delta_features,
    history_features,
    lag_features,
    rolling_rows,
)
from meterlab.operators.grid import direct_label, regular_grid, resample, seasonal_lag
from meterlab.operators.model import (
    assemble_stage,
    forecast,
    load_model,
    save_model,
    scale_stage,
    split_by_key,
    split_by_time,
    train,
)
from meterlab.operators.select import between, peaks
from meterlab.operators.sessions import outages, sessions
from meterlab.operators.sketches import merge_sketches, sketch_table, sketched
from meterlab.operators.trailing import rolling_time
from meterlab.operators.weighted import ewm_features

__all__ = [
    "MISSING_TOKENS",
    "apply_schema",
    "asof_join",
    "assemble_stage",
    "between",
    "calendar_features",
    "calendar_flags",
    "change_points",
    "conversion_report",
    "correlations",
    "cyclic_features",
    "decompose",
    "delta_features",
    "direct_label",
    "drop_missing",
    "errors",
    "ewm_features",
    "exact_quantiles",
    "fill_constant",
    "fill_forward",
    "fill_mean",
    "forecast",
    "histogram",
    "history_features",
    "impute_stage",
    "lag_features",
    "load_model",
    "load_profile",
    "merge_sketches",
    "naive_forecast",
    "null_profile",
    "null_tokens",
    "outages",
    "peaks",
    "plot_table",
    "regular_grid",
    "resample",
    "rmse",
    "rolling_rows",
    "rolling_time",
    "save_model",
    "scale_stage",
    "seasonal_lag",
    "sessions",
    "share",
    "sketch_table",
    "sketched",
    "split_by_key",
    "split_by_time",
    "summarise",
    "to_number",
    "to_ts",
    "train",
    "trend",
]
