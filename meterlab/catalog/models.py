"""Splits, feature vectors, training, forecasts and their errors.

A model has no SQL twin. What SQL can say about a forecast is checked: which
rows it covers, their labels, and that reloading a model changes nothing. The
quality of the model is asserted in the tests.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import meterlab as m
from meterlab.catalog.features import _grid_sql, _hourly
from meterlab.catalog.fixtures import (
    CUTOFF,
    EVENT_NAMES,
    ONE_METER,
    ORDER,
    READINGS,
    READINGS_NULL,
    READINGS_SIGNAL,
    one_meter,
    readings,
    readings_null,
    readings_signal,
)
from meterlab.catalog.registry import exact_mean, registered, round_sql, rounded
from meterlab.plans.blocks import scratch_path
from meterlab.plans.forecast_run import fit_and_forecast, make_features

_CALENDAR = ["hour", "weekday"]


def _with_calendar(spark, folder):
    return m.calendar_features(readings(spark, folder), parts=_CALENDAR)


def _unpacked(df, vector, names):
    values = vector_to_array(vector)
    return df.select("event_id", *[values[i].alias(name) for i, name in enumerate(names)])


@registered(
    f"""WITH {READINGS}
    SELECT event_id, CAST(hour(ts) AS DOUBLE) AS f0, CAST(isodow(ts) - 1 AS DOUBLE) AS f1,
           power_kw AS f2
    FROM readings"""
)
def assemble_stage(spark, folder):
    stage = m.assemble_stage([*_CALENDAR, "power_kw"])
    return _unpacked(stage.transform(_with_calendar(spark, folder)), "features", ["f0", "f1", "f2"])


def _scaled(spark, folder, kind):
    """Scaling learnt on the training part, applied to all rows."""
    df = m.assemble_stage(["hour", "power_kw"]).transform(_with_calendar(spark, folder))
    model = m.scale_stage(kind).fit(m.split_by_time(df, CUTOFF)[0])
    return rounded(_unpacked(model.transform(df), "scaled", ["hour", "power"]), ["hour", "power"])


_LEARNT = f"""WITH {READINGS}, learnt AS (
      SELECT avg(hour(ts)) AS hour_mean, stddev_samp(hour(ts)) AS hour_std,
             avg(power_kw) AS power_mean, stddev_samp(power_kw) AS power_std,
             min(hour(ts)) AS hour_min, max(hour(ts)) AS hour_max,
             min(power_kw) AS power_min, max(power_kw) AS power_max
      FROM readings WHERE ts < TIMESTAMP '{CUTOFF}')"""


@registered(
    f"""{_LEARNT}
    SELECT event_id, {round_sql("(hour(ts) - hour_mean) / hour_std", "hour")},
           {round_sql("(power_kw - power_mean) / power_std", "power")}
    FROM readings, learnt"""
)
def scale_stage(spark, folder):
    return _scaled(spark, folder, "standard")


@registered(
    f"""{_LEARNT}
    SELECT event_id, {round_sql("(hour(ts) - hour_min) / (hour_max - hour_min)", "hour")},
           {round_sql("(power_kw - power_min) / (power_max - power_min)", "power")}
    FROM readings, learnt"""
)
def scale_stage_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@registered(
    f"""WITH {READINGS}
    SELECT event_id, CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS part
    FROM readings"""
)
def split_by_time(spark, folder):
    training, test = m.split_by_time(readings(spark, folder), CUTOFF)
    return training.select("event_id", F.lit("train").alias("part")).unionByName(
        test.select("event_id", F.lit("test").alias("part"))
    )


@registered(
    f"""WITH {READINGS}
    SELECT true AS share_kept_as_asked, count(*) AS n_rows FROM readings"""
)
def split_by_key_share(spark, folder):
    """Four rows out of five are in the first part, up to five standard deviations."""
    first, second = (p.agg(F.count("*").alias("n")) for p in m.split_by_key(readings(spark, folder), "event_id", 0.8))
    sizes = first.withColumn("part", F.lit(1)).unionByName(second.withColumn("part", F.lit(2)))
    total = F.sum("n")
    one = F.sum(F.when(F.col("part") == 1, F.col("n")))
    kept = F.abs(one - F.lit(0.8) * total) <= 5 * F.sqrt(total * 0.16)
    return sizes.agg(kept.alias("share_kept_as_asked"), total.alias("n_rows"))


@registered(f"WITH {READINGS} SELECT event_id, CAST(1 AS BIGINT) AS n_parts FROM readings")
def split_by_key(spark, folder):
    """Each row is in exactly one part."""
    parts = m.split_by_key(readings(spark, folder), "event_id", 0.8)
    both = parts[0].select("event_id").unionAll(parts[1].select("event_id"))
    return both.groupBy("event_id").agg(F.count("*").alias("n_parts"))


@registered(
    f"""WITH {_grid_sql(READINGS, "hour")}
    SELECT meter_id, bucket, n_readings, power_kw_max,
           lead(power_kw_max, 3) OVER (PARTITION BY meter_id ORDER BY bucket) AS label
    FROM grid"""
)
def direct_label(spark, folder):
    return m.direct_label(_hourly(spark, folder), "power_kw_max", 3, unique=True)


_NAIVE_MEAN = f"""WITH {{0}}, past AS (
      SELECT {{1}} {exact_mean("power_kw")} AS forecast
      FROM readings WHERE ts < TIMESTAMP '{CUTOFF}' {{2}})"""


@registered(
    _NAIVE_MEAN.format(READINGS, "meter_id,", "GROUP BY meter_id")
    + f"""
    SELECT event_id, power_kw, forecast FROM readings LEFT JOIN past USING (meter_id)
    WHERE ts >= TIMESTAMP '{CUTOFF}'"""
)
def naive_forecast_mean(spark, folder):
    df = m.naive_forecast(readings(spark, folder), "mean", cutoff=CUTOFF, scale=2)
    return m.split_by_time(df, CUTOFF)[1].select("event_id", "power_kw", "forecast")


@registered(
    f"""WITH {ONE_METER}
    SELECT event_id, power_kw,
           lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS forecast
    FROM readings"""
)
def naive_forecast_last_one_meter(spark, folder):
    df = one_meter(spark, folder)
    df = m.naive_forecast(df, "last", order=ORDER, block_rows=2_000)
    return df.select("event_id", "power_kw", "forecast")


def _last(spark, folder):
    return m.naive_forecast(readings(spark, folder), "last", order=ORDER)


def _season(spark, folder):
    grid = _hourly(spark, folder)
    return m.naive_forecast(grid, "season", "power_kw_max", ts="bucket", unique=True)


_LAST = """last AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS forecast
      FROM readings)"""
_SEASON = """season AS (
      SELECT now.*, ago.power_kw_max AS forecast FROM grid now LEFT JOIN grid ago
        ON now.meter_id = ago.meter_id AND ago.bucket = now.bucket - INTERVAL 24 HOURS)"""


def _rmse_sql(label: str) -> str:
    return f"count(forecast - {label}) AS n, " + round_sql(
        f"sqrt(avg(pow(forecast - {label}, 2)))", "rmse"
    )


@registered(
    _NAIVE_MEAN.format(READINGS, "", "")
    + f"""
    SELECT {_rmse_sql("power_kw")} FROM readings, past WHERE ts >= TIMESTAMP '{CUTOFF}'"""
)
def rmse_of_mean(spark, folder):
    df = m.naive_forecast(readings(spark, folder), "mean", by=(), cutoff=CUTOFF, scale=2)
    test = m.split_by_time(df, CUTOFF)[1]
    return rounded(m.rmse(test, "power_kw", "forecast"), ["rmse"])


@registered(f"""WITH {READINGS}, {_LAST} SELECT {_rmse_sql("power_kw")} FROM last""")
def rmse_of_last_value(spark, folder):
    return rounded(m.rmse(_last(spark, folder), "power_kw", "forecast"), ["rmse"])


@registered(
    f"""WITH {_grid_sql(READINGS, "hour")}, {_SEASON}
    SELECT {_rmse_sql("power_kw_max")} FROM season"""
)
def rmse_of_same_hour_yesterday(spark, folder):
    return rounded(m.rmse(_season(spark, folder), "power_kw_max", "forecast"), ["rmse"])


_ERRORS = ", ".join(
    [
        "count(*) AS n",
        round_sql("sqrt(avg(pow(forecast - power_kw, 2)))", "rmse"),
        round_sql("avg(abs(forecast - power_kw))", "mae"),
        round_sql("avg(forecast - power_kw)", "bias"),
        round_sql("1 - avg(pow(forecast - power_kw, 2)) / var_pop(power_kw)", "r2"),
    ]
)
_MEASURES = ["rmse", "mae", "bias", "r2"]


@registered(
    f"WITH {READINGS}, {_LAST} SELECT {_ERRORS} FROM last WHERE forecast IS NOT NULL"
)
def errors(spark, folder):
    return rounded(m.errors(_last(spark, folder), "power_kw", "forecast"), _MEASURES)


@registered(
    f"""WITH {READINGS}, {_LAST}
    SELECT channel, {_ERRORS} FROM last WHERE forecast IS NOT NULL GROUP BY channel"""
)
def errors_per_channel(spark, folder):
    measured = m.errors(_last(spark, folder), "power_kw", "forecast", ["channel"])
    return rounded(measured, _MEASURES)


def _config(**changes):
    return m.ForecastConfig(**({"cutoff": CUTOFF, "label": "target"} | changes))


def _forecasts(spark, folder):
    return m.run(spark, readings_signal(spark, folder), _config())


@registered(
    f"""WITH {READINGS_SIGNAL}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous
      FROM readings)
    SELECT event_id, meter_id, ts, target AS label, true AS forecast_close FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""
)
def gbt_forecast(spark, folder):
    """Forecasts of boosted trees for the test part, and whether they come near the label.

    Labels lie between 0.2 and 2.36; a forecast is close within 0.5.
    """
    close = (F.abs(F.col("prediction") - F.col("label")) < 0.5).alias("forecast_close")
    return _forecasts(spark, folder).select("event_id", "meter_id", "ts", "label", close)


@registered(
    f"""WITH {READINGS_SIGNAL}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous
      FROM readings)
    SELECT count(*) AS n, true AS near_noise, true AS far_below_mean FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""
)
def forecast_quality(spark, folder):
    """The error on the planted signal, whose noise has a deviation of 0.02.

    Below 0.05 kW, and below a tenth of the error of the mean.
    """
    forecasts = _forecasts(spark, folder)
    rmse = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))
    return forecasts.agg(
        F.count("prediction").alias("n"),
        (rmse < 0.05).alias("near_noise"),
        (rmse < F.stddev_pop("label") / 10).alias("far_below_mean"),
    )


@registered(
    f"""WITH {READINGS_SIGNAL}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous
      FROM readings)
    SELECT count(*) AS n_rows, count(*) AS n_forecasts, CAST(0 AS BIGINT) AS n_labels FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""
)
def forecast_without_labels(spark, folder):
    """From the cutoff on no label is known, and every row gets a forecast."""
    df = readings_signal(spark, folder)
    df = df.withColumn("target", F.when(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"), F.col("target")))
    return m.run(spark, df, _config()).agg(
        F.count("*").alias("n_rows"),
        F.count("prediction").alias("n_forecasts"),
        F.count("label").alias("n_labels"),
    )


_TEST_ROWS = f"""WITH {READINGS_SIGNAL}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous
      FROM readings)
    SELECT event_id, target AS label, true AS forecast_made FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""


@registered(_TEST_ROWS)
def gbt_forecast_rows(spark, folder):
    """Every complete row of the test part gets a forecast, and keeps its label."""
    made = F.col("prediction").isNotNull().alias("forecast_made")
    return _forecasts(spark, folder).select("event_id", "label", made)


@registered(
    f"""WITH {READINGS_SIGNAL}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous
      FROM readings)
    SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_changed FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""
)
def save_and_load_model(spark, folder):
    """A model that was stored and loaded forecasts the same."""
    config = _config()
    df, features = make_features(readings_signal(spark, folder), config)
    model, forecasts = fit_and_forecast(df, features, config)
    path = scratch_path(spark, "model")
    m.save_model(model, path)
    again = m.forecast(m.load_model(path), forecasts.withColumnRenamed("prediction", "first"))
    changed = F.abs(F.col("prediction") - F.col("first")) > 1e-12
    return again.agg(
        F.count("*").alias("n"),
        F.count_if(changed | F.col("prediction").isNull()).alias("n_changed"),
    )


@registered(
    f"""WITH {READINGS_NULL}, filled AS (
      SELECT *, last_value(power_kw IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY ts, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known
      FROM readings), history AS (
      SELECT *, lag(known) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous
      FROM filled)
    SELECT event_id, power_kw AS label, true AS forecast_made FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""
)
def gbt_forecast_with_filled_gaps(spark, folder):
    """Gaps are filled from the past for the features, never for the label."""
    config = _config(label="power_kw", missing="forward")
    forecasts = m.run(spark, readings_null(spark, folder), config)
    made = F.col("prediction").isNotNull().alias("forecast_made")
    return forecasts.select("event_id", "label", made)


@registered(
    f"""WITH {READINGS}, history AS (
      SELECT *, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS previous
      FROM readings)
    SELECT event_id, power_kw AS label, true AS forecast_made FROM history
    WHERE previous IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}'"""
)
def forecast_from_stored_table(spark, folder):
    """The complete way from a stored table to forecasts."""
    config = _config(label=None, rename=EVENT_NAMES, scale="standard")
    forecasts = m.run(spark, f"{folder}/events.parquet", config)
    made = F.col("prediction").isNotNull().alias("forecast_made")
    return forecasts.select("event_id", "label", made)


@registered(
    f"""WITH {_grid_sql(READINGS_SIGNAL.replace("value AS power_kw", "value AS load"), "hour")
      .replace("power_kw", "target")}, labelled AS (
      SELECT meter_id, bucket, target_max,
             lead(target_max, 3) OVER (PARTITION BY meter_id ORDER BY bucket) AS label
      FROM grid)
    SELECT meter_id, bucket, label, true AS forecast_made FROM labelled
    WHERE target_max IS NOT NULL AND bucket >= TIMESTAMP '{CUTOFF}'"""
)
def gbt_forecast_three_hours_ahead(spark, folder):
    """The label is the value three hours later; every feature is known at the forecast."""
    config = _config(
        label=None, value="target", step="hour", horizon=3, agg="max", lags=(), rolling=()
    )
    made = F.col("prediction").isNotNull().alias("forecast_made")
    forecasts = m.run(spark, readings_signal(spark, folder), config)
    return forecasts.select("meter_id", F.col("ts").alias("bucket"), "label", made)
