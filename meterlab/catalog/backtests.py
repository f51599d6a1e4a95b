"""Backtests, forecasts that feed on themselves, and what features are worth."""

from __future__ import annotations

from pyspark.sql import functions as F

import meterlab as m
from meterlab.catalog.fixtures import CUTOFF, ORDER, READINGS_SIGNAL, readings_signal
from meterlab.catalog.models import _config
from meterlab.catalog.registry import registered
from meterlab.plans.blocks import settle
from meterlab.plans.forecast_run import fit_and_forecast, make_features

_CUTOFFS = ("2024-01-12 00:00:00", "2024-01-18 00:00:00", "2024-01-24 00:00:00")


@registered(
    f"""WITH {READINGS_SIGNAL}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous FROM readings),
    cutoffs AS (SELECT unnest([{", ".join(f"TIMESTAMP '{c}'" for c in _CUTOFFS)}]) AS cutoff)
    SELECT cutoff, count(*) AS n, count(*) AS n_forecasts, count(*) AS n_labels,
           CAST(sum(CAST(target AS DECIMAL(18,6))) AS DOUBLE) AS label_sum,
           min(ts) AS first_ts, max(ts) AS last_ts, true AS near
    FROM history JOIN cutoffs ON ts >= cutoff AND ts < cutoff + INTERVAL 3 DAYS
    WHERE previous IS NOT NULL GROUP BY cutoff"""
)
def backtest_folds(spark, folder):
    """The rows of each fold, and that its forecasts come near the planted signal."""
    found = m.backtest(readings_signal(spark, folder), _config(params={"maxIter": 10, "maxDepth": 4}), _CUTOFFS, "3 days")
    miss = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))
    mean_miss = F.stddev_pop("label")
    return found.groupBy("cutoff").agg(
        F.count("*").alias("n"),
        F.count("prediction").alias("n_forecasts"),
        F.count("label").alias("n_labels"),
        F.sum(F.col("label").cast("decimal(18,6)")).cast("double").alias("label_sum"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        (miss < 0.6 * mean_miss).alias("near"),
    )


def _hourly_signal(spark, folder):
    """The planted signal at every hour in which any meter read, as one series."""
    df = readings_signal(spark, folder).withColumn("target", F.col("target") - F.lit(0.01) * (F.col("event_id") % 7))
    hours = df.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("target").alias("load"))
    return hours.select(F.lit(0).cast("bigint").alias("meter_id"), "ts", "load")


@registered(
    f"""WITH {READINGS_SIGNAL}, hours AS (
      SELECT DISTINCT date_trunc('hour', ts) AS ts FROM readings WHERE ts < TIMESTAMP '{CUTOFF}'),
    steps AS (SELECT CAST(unnest(range(1, 25)) AS BIGINT) AS step_ahead)
    SELECT CAST(0 AS BIGINT) AS meter_id, max(ts) + to_hours(step_ahead) AS ts, step_ahead,
           true AS forecast_made, true AS near
    FROM hours, steps GROUP BY step_ahead"""
)
def recursive_forecast(spark, folder):
    """A day ahead, hour by hour, near the planted signal without its noise."""
    history = _hourly_signal(spark, folder).where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    config = m.ForecastConfig(
        CUTOFF, value="load", key="ts", parts=("hour", "weekday"), lags=(1, 2), rolling=(3,), params={"maxIter": 20, "maxDepth": 5},
    )
    df, features = make_features(history, config)
    model = m.train(m.drop_missing(df, features), features)
    ahead = m.recursive_forecast(model, history, 24, "hour", "load", (1, 2), (3,), parts=("hour", "weekday"))
    true = 1 + 0.8 * F.sin(2 * F.pi() * F.hour("ts") / 24) + F.when(F.weekday("ts") >= 5, 0.5).otherwise(0)
    return ahead.select(
        "meter_id", "ts", F.col("step_ahead").cast("bigint").alias("step_ahead"),
        F.col("prediction").isNotNull().alias("forecast_made"),
        (F.abs(F.col("prediction") - true) < 0.35).alias("near"),
    )


@registered("SELECT 'hour' AS feature, count(*) > 0 AS first, true AS clearly, CAST(4 AS BIGINT) AS n_features FROM events")
def importance_of_features(spark, folder):
    """The planted signal follows the hour, so the hour comes first, by far."""
    config = _config(params={"maxIter": 10, "maxDepth": 4})
    df, features = make_features(readings_signal(spark, folder), config)
    model, forecasts = fit_and_forecast(df, features, config)
    worth = m.permutation_importance(model, forecasts.drop("prediction"), features, key=ORDER[1:])
    return worth.agg(
        F.max_by("feature", "loss").alias("feature"),
        (F.max("loss") == F.max(F.when(F.col("feature") == "hour", F.col("loss")))).alias("first"),
        (F.max("loss") > 2 * F.max(F.when(F.col("feature") != "hour", F.col("loss")))).alias("clearly"),
        F.count("*").alias("n_features"),
    )


@registered(
    f"""WITH {READINGS_SIGNAL}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous FROM readings)
    SELECT count(*) AS n, true AS fewer_trees, true AS no_worse FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""
)
def search_with_early_stop(spark, folder):
    """Boosting ends before its limit, and forecasts the test part about as well as all trees of the same rows do."""
    df, features = make_features(readings_signal(spark, folder), _config())
    complete = settle(m.drop_missing(df, [*features, "label"]), "complete")
    training, test = m.split_by_time(complete, CUTOFF)
    latest = "2024-01-19 00:00:00"
    candidates = [{"maxIter": 40, "maxDepth": d, "stepSize": 0.3, "validationTol": 0.0001} for d in (3, 5)]
    model, told = m.search(training, features, candidates, latest)
    settings = {k: v for k, v in told[0]["params"].items() if k != "validationTol"}
    full = m.train(m.split_by_time(training, latest)[0], features, params=settings)
    both = m.forecast(full, m.forecast(model, test).withColumnRenamed("prediction", "early"))
    miss = lambda c: F.sqrt(F.avg(F.pow(F.col(c) - F.col("label"), 2)))
    return both.agg(
        F.count("*").alias("n"),
        F.lit(told[0]["trees"] < 40).alias("fewer_trees"),
        (miss("early") <= 1.1 * miss("prediction")).alias("no_worse"),
    )
