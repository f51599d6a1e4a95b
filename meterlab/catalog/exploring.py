"""Exploratory aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

import meterlab as m
from meterlab.catalog.fixtures import (
    DAILY_ORDERS,
    READINGS,
    READINGS_NULL,
    daily_orders,
    readings,
    readings_null,
)
from meterlab.catalog.registry import (
    exact_mean,
    exact_sum,
    long_ints,
    registered,
    round_sql,
    rounded,
)

_TREND = f"""WITH {{0}}
    SELECT CAST(date_trunc('{{1}}', ts) AS TIMESTAMP) AS bucket, count(*) AS n_readings,
           {exact_sum("power_kw")} AS total, {exact_mean("power_kw")} AS mean,
           max(power_kw) AS max
    FROM readings GROUP BY 1"""


@registered(_TREND.format(READINGS, "day"))
def trend_per_day(spark, folder):
    return m.trend(readings(spark, folder), "day", scale=2)


@registered(_TREND.format(DAILY_ORDERS, "week"))
def trend_per_week(spark, folder):
    return m.trend(daily_orders(spark, folder), "week", scale=2)


@registered(_TREND.format(DAILY_ORDERS, "month"))
def trend_per_month(spark, folder):
    return m.trend(daily_orders(spark, folder), "month", scale=2)


@registered(_TREND.format(DAILY_ORDERS, "quarter"))
def trend_per_quarter(spark, folder):
    return m.trend(daily_orders(spark, folder), "quarter", scale=2)


@registered(_TREND.format(DAILY_ORDERS, "year"))
def trend_per_year(spark, folder):
    return m.trend(daily_orders(spark, folder), "year", scale=2)


@registered(
    f"""SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS bucket,
           count(*) AS n_readings, {exact_sum("l_quantity")} AS total,
           {exact_mean("l_quantity")} AS mean, max(l_quantity) AS max
    FROM lineitem GROUP BY 1, 2"""
)
def trend_of_groups(spark, folder):
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    return m.trend(items, "month", "l_quantity", "l_shipdate", ["l_returnflag"], scale=2)


_HOUR = "CAST(hour(ts) AS BIGINT)"
_WEEKDAY = "CAST(isodow(ts) - 1 AS BIGINT)"


@registered(
    f"""WITH {READINGS}
    SELECT {_HOUR} AS hour, count(*) AS n_readings, {exact_mean("power_kw")} AS mean
    FROM readings GROUP BY 1"""
)
def load_profile_hour(spark, folder):
    return long_ints(m.load_profile(readings(spark, folder), scale=2))


@registered(
    f"""WITH {READINGS}
    SELECT {_WEEKDAY} AS weekday, {_HOUR} AS hour, count(*) AS n_readings,
           {exact_mean("power_kw")} AS mean
    FROM readings GROUP BY 1, 2"""
)
def load_profile_weekday_hour(spark, folder):
    return long_ints(m.load_profile(readings(spark, folder), ["weekday", "hour"], scale=2))


_HOURS = ", ".join(
    f"CAST(sum(CAST(power_kw AS DECIMAL(18,2))) FILTER (WHERE hour(ts) = {h}) AS DOUBLE)"
    f" / nullif(count(power_kw) FILTER (WHERE hour(ts) = {h}), 0) AS h{h}"
    for h in range(24)
)


@registered(
    f"""WITH {READINGS}
    SELECT {_WEEKDAY} AS weekday, count(*) AS n_readings, {_HOURS} FROM readings GROUP BY 1"""
)
def load_profile_wide(spark, folder):
    df = readings(spark, folder)
    return long_ints(m.load_profile(df, ["weekday", "hour"], scale=2, wide=True))


_SAMPLE_TO_POPULATION = "(count(power_kw) - 2) / sqrt(count(power_kw) * (count(power_kw) - 1.0))"
_SUMMARY = ", ".join(
    [
        "count(power_kw) AS n",
        round_sql("avg(power_kw)", "mean"),
        round_sql("stddev_samp(power_kw)", "std"),
        "min(power_kw) AS min",
        "max(power_kw) AS max",
        round_sql(f"skewness(power_kw) * {_SAMPLE_TO_POPULATION}", "skewness"),
        round_sql("kurtosis_pop(power_kw)", "kurtosis"),
        round_sql("quantile_cont(power_kw, 0.25)", "q25"),
        round_sql("quantile_cont(power_kw, 0.5)", "q50"),
        round_sql("quantile_cont(power_kw, 0.75)", "q75"),
    ]
)
_DIGITS = ["mean", "std", "skewness", "kurtosis", "q25", "q50", "q75"]


@registered(f"WITH {READINGS} SELECT {_SUMMARY} FROM readings")
def summarise(spark, folder):
    return rounded(m.summarise(readings(spark, folder)), _DIGITS)


@registered(f"WITH {READINGS_NULL} SELECT channel, {_SUMMARY} FROM readings GROUP BY channel")
def summarise_per_channel(spark, folder):
    return rounded(m.summarise(readings_null(spark, folder), by=["channel"]), _DIGITS)


@registered(f"WITH {READINGS_NULL} SELECT channel, {_SUMMARY} FROM readings GROUP BY channel")
def summarise_large_groups(spark, folder):
    """The same with groups taken as too large for one task."""
    df = readings_null(spark, folder)
    return rounded(m.summarise(df, by=["channel"], block_rows=500), _DIGITS)


@registered(f"WITH {DAILY_ORDERS} SELECT {_SUMMARY} FROM readings")
def summarise_large_table(spark, folder):
    return rounded(m.summarise(daily_orders(spark, folder), block_rows=2_000), _DIGITS)


@registered(
    f"""WITH {READINGS}
    SELECT CAST(floor(power_kw / 10.0::DOUBLE) AS BIGINT) AS bin,
           floor(power_kw / 10.0::DOUBLE) * 10.0::DOUBLE AS bin_start, count(*) AS n
    FROM readings GROUP BY 1, 2"""
)
def histogram(spark, folder):
    return m.histogram(readings(spark, folder), width=10.0)


@registered(
    f"""WITH {READINGS}
    SELECT 'power_kw' AS a, 'hour' AS b, count(*) AS n,
           {round_sql("corr(power_kw, hour(ts))", "corr")} FROM readings
    UNION ALL SELECT 'power_kw', 'weekday', count(*),
           {round_sql("corr(power_kw, isodow(ts) - 1)", "corr")} FROM readings
    UNION ALL SELECT 'hour', 'weekday', count(*),
           {round_sql("corr(hour(ts), isodow(ts) - 1)", "corr")} FROM readings"""
)
def correlations(spark, folder):
    df = m.calendar_features(readings(spark, folder), parts=["hour", "weekday"])
    return rounded(m.correlations(df, ["power_kw", "hour", "weekday"]), ["corr"])


@registered(
    f"""WITH {READINGS}, sums AS (
      SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS bucket, channel,
             {exact_sum("power_kw")} AS total
      FROM readings GROUP BY 1, 2),
    days AS (SELECT bucket, {exact_sum("total")} AS day_total FROM sums GROUP BY bucket)
    SELECT bucket, channel, total, total / day_total AS share FROM sums JOIN days USING (bucket)"""
)
def share_per_day(spark, folder):
    return m.share(readings(spark, folder), scale=2)


@registered(
    f"""WITH {READINGS}
    SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS bucket, {exact_sum("power_kw")} AS total
    FROM readings GROUP BY 1 ORDER BY total DESC, bucket LIMIT 10"""
)
def plot_table(spark, folder):
    """The ten days with the largest totals, ready for a plot."""
    days = m.trend(readings(spark, folder), "day", scale=2).select("bucket", "total")
    return m.plot_table(days, [F.desc("total"), "bucket"], 10)
