"""As-of joins, weighted means, runs of readings and outages; trailing statistics beside NaN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

import meterlab as m
from meterlab.catalog.features import BLOCK_ROWS, _keyed
from meterlab.catalog.fixtures import (
    DAILY_ORDERS,
    ONE_METER,
    ONE_METER_NULL,
    ORDER,
    READINGS,
    READINGS_NULL,
    daily_orders,
    one_meter,
    one_meter_null,
    readings,
    readings_null,
)
from meterlab.catalog.registry import registered, round_sql, rounded
from meterlab.plans.blocks import scratch_path


@registered(
    f"""WITH {READINGS}, last_orders AS (
      SELECT o_custkey AS meter_id, o_orderdate AS ts, max(o_orderkey) AS order_key,
             arg_max(o_totalprice, o_orderkey) AS price
      FROM orders GROUP BY ALL), shipped AS (
      SELECT l_orderkey * 10 + l_linenumber AS line, l_suppkey AS meter_id, l_shipdate AS ts FROM lineitem)
    SELECT line, o.ts AS ts_asof, order_key AS event_id_asof, price AS power_kw_asof
    FROM shipped s ASOF LEFT JOIN last_orders o ON s.meter_id = o.meter_id AND s.ts >= o.ts"""
)
def asof_orders(spark, folder):
    """For each shipped line the last order of the customer of the supplier's number, until its date."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
        F.col("l_suppkey").alias("meter_id"),
        F.col("l_shipdate").alias("ts"),
    )
    joined = m.asof_join(lines, daily_orders(spark, folder), cols=["event_id", "power_kw"], order=["event_id"])
    return joined.select("line", "ts_asof", "event_id_asof", "power_kw_asof")


_CLICKS = f"""WITH {{0}}, clicks AS (SELECT * FROM readings WHERE channel = 'click'),
    met AS (
      SELECT r.event_id, c.ts AS ts_asof, c.power_kw AS power_kw_asof
      FROM readings r ASOF LEFT JOIN clicks c ON r.meter_id = c.meter_id AND r.ts {{1}} c.ts)"""


def _clicks(df):
    return df.where(F.col("channel") == "click").select("meter_id", "ts", "power_kw")


@registered(
    _CLICKS.format(READINGS, ">")
    + """ SELECT m.event_id, CASE WHEN near THEN ts_asof END AS ts_asof, CASE WHEN near THEN power_kw_asof END AS power_kw_asof
    FROM (SELECT met.*, readings.ts - ts_asof <= INTERVAL 36 HOURS AS near FROM met JOIN readings USING (event_id)) m"""
)
def asof_within_tolerance(spark, folder):
    """The last click strictly before each reading, no longer than 36 hours ago."""
    df = readings(spark, folder)
    joined = m.asof_join(df, _clicks(df), tolerance="36 hours", exact=False)
    return joined.select("event_id", "ts_asof", "power_kw_asof")


@registered(_CLICKS.format(ONE_METER, ">=") + " SELECT * FROM met")
def asof_one_meter(spark, folder):
    df = one_meter(spark, folder)
    joined = m.asof_join(df, _clicks(df), block_rows=BLOCK_ROWS)
    return joined.select("event_id", "ts_asof", "power_kw_asof")


@registered(_CLICKS.format(ONE_METER, "<=") + " SELECT * FROM met")
def asof_forward_without_keys(spark, folder):
    """The next click of any meter: no key, time alone."""
    df = one_meter(spark, folder)
    joined = m.asof_join(df, _clicks(df).drop("meter_id"), by=(), direction="forward", block_rows=BLOCK_ROWS)
    return joined.select("event_id", "ts_asof", "power_kw_asof")


def _ewm_sql(table: str, position: str, half_life: str, name: str) -> str:
    """All pairs of a row and an earlier reading, weighted against the latest of these."""
    mean = "sum(w * power_kw) / sum(w)"
    return f"""WITH {table}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS place,
             count(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS number FROM readings),
    placed AS (SELECT meter_id, event_id, place, power_kw, {position} AS e FROM numbered),
    pairs AS (
      SELECT a.event_id, b.power_kw, b.e - max(b.e) OVER (PARTITION BY a.event_id) AS apart
      FROM placed a JOIN placed b ON a.meter_id = b.meter_id AND b.place < a.place AND b.power_kw IS NOT NULL),
    weighed AS (SELECT event_id, power_kw, power(2.0::DOUBLE, greatest(apart / {half_life}, -1000)) AS w FROM pairs),
    means AS (SELECT event_id, {round_sql(mean, "mean")} FROM weighed GROUP BY event_id)
    SELECT event_id, mean AS {name} FROM readings LEFT JOIN means USING (event_id)"""


# Whole microseconds, so that differences are exact.
_MICROS = "epoch_us(ts)"


@registered(_ewm_sql(READINGS, _MICROS, "21600e6", "power_kw_ewm_6_hours"))
def ewm_time(spark, folder):
    df = _keyed(m.ewm_features(readings(spark, folder), order=ORDER))
    return rounded(df, ["power_kw_ewm_6_hours"])


# So short a half-life that most cells hold few readings and many hold none.
@registered(_ewm_sql(READINGS_NULL, _MICROS, "60e6", "power_kw_ewm_1_minute"))
def ewm_time_over_many_cells(spark, folder):
    df = m.ewm_features(readings_null(spark, folder), half_life="1 minute", order=ORDER)
    return rounded(_keyed(df), ["power_kw_ewm_1_minute"])


# Ever fewer pairs weigh anything, but SQL makes them all: of each day only the last hour is kept.
_EVENING = "readings AS (SELECT * FROM all_readings WHERE hour(ts) >= 22)"


@registered(_ewm_sql(ONE_METER_NULL.replace("readings AS", "all_readings AS", 1) + f", {_EVENING}", _MICROS, "86400e6", "power_kw_ewm_1_day"))
def ewm_one_meter(spark, folder):
    df = one_meter_null(spark, folder).where(F.hour("ts") >= 22)
    df = m.ewm_features(df, half_life="1 day", order=ORDER, block_rows=BLOCK_ROWS // 10)
    return rounded(_keyed(df), ["power_kw_ewm_1_day"])


@registered(_ewm_sql(READINGS_NULL, "number", "3", "power_kw_ewm_3"))
def ewm_of_readings(spark, folder):
    df = m.ewm_features(readings_null(spark, folder), half_life=3, order=ORDER)
    return rounded(_keyed(df), ["power_kw_ewm_3"])


@registered(
    _ewm_sql(READINGS, _MICROS, "172800e6", "forecast")
    .replace("SELECT event_id, mean AS forecast FROM readings", "SELECT count(mean) AS n, " + round_sql("sqrt(avg((mean - power_kw) ** 2))", "rmse", 4) + " FROM readings")
)
def rmse_of_smoothing_forecast(spark, folder):
    df = m.naive_forecast(readings(spark, folder), "smooth", order=ORDER, period="2 days")
    return rounded(m.rmse(df, "power_kw", "forecast"), ["rmse"], 4)


def _runs_sql(table: str, hours: int) -> str:
    return f"""WITH {table}, held AS (SELECT DISTINCT meter_id, ts FROM readings WHERE power_kw IS NOT NULL),
    looked AS (SELECT *, lag(ts) OVER (PARTITION BY meter_id ORDER BY ts) AS before FROM held),
    marked AS (SELECT *, coalesce(ts - before > INTERVAL {hours} HOURS, false) AS gap FROM looked)"""


_OUTAGES = """ SELECT meter_id, before AS outage_start, ts AS outage_end,
      date_sub('microsecond', before, ts) // 1000000 AS seconds FROM marked WHERE gap"""
_SESSIONS = """, numbered AS (
      SELECT *, sum(gap::INT) OVER (PARTITION BY meter_id ORDER BY ts) AS session FROM marked),
    sized AS (SELECT meter_id, ts, count(*) AS n FROM readings WHERE power_kw IS NOT NULL GROUP BY ALL)
    SELECT meter_id, CAST(session AS BIGINT) AS session, min(ts) AS session_start, max(ts) AS session_end,
           CAST(sum(n) AS BIGINT) AS n_readings
    FROM numbered JOIN sized USING (meter_id, ts) GROUP BY meter_id, session"""


@registered(_runs_sql(READINGS_NULL, 24) + _OUTAGES)
def outages(spark, folder):
    return m.outages(readings_null(spark, folder), "24 hours")


@registered(_runs_sql(ONE_METER_NULL, 2) + _OUTAGES)
def outages_one_meter(spark, folder):
    return m.outages(one_meter_null(spark, folder), "2 hours", block_rows=BLOCK_ROWS // 4)


@registered(_runs_sql(READINGS, 12) + _SESSIONS)
def sessions(spark, folder):
    return m.sessions(readings(spark, folder), "12 hours")


@registered(_runs_sql(ONE_METER_NULL, 3) + _SESSIONS)
def sessions_one_meter(spark, folder):
    return m.sessions(one_meter_null(spark, folder), "3 hours", block_rows=BLOCK_ROWS // 4)


@registered(_runs_sql(DAILY_ORDERS, 24 * 200) + _SESSIONS)
def sessions_of_customers(spark, folder):
    """Several orders on one day are one instant."""
    return m.sessions(daily_orders(spark, folder), "200 days")


def _with_nan(spark, folder):
    """Every seventh value is NaN, which must count as missing."""
    nan = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("power_kw"))
    return readings(spark, folder).withColumn("power_kw", nan)


def _trailing_sql(frame: str, name: str) -> str:
    total = f"CAST(sum(CAST(power_kw AS DECIMAL(18,2))) {frame} AS DOUBLE)"
    return f"""WITH {READINGS_NULL}
    SELECT event_id, count(power_kw) {frame} AS {name}_count, {total} AS {name}_sum,
           {total} / nullif(count(power_kw) {frame}, 0) AS {name}_mean,
           {round_sql(f"stddev_samp(power_kw) {frame}", f"{name}_std")},
           min(power_kw) {frame} AS {name}_min, max(power_kw) {frame} AS {name}_max
    FROM readings"""


_ALL = ("count", "sum", "mean", "std", "min", "max")
_BY_ROWS = "OVER (PARTITION BY meter_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)"
_BY_TIME = """OVER (PARTITION BY meter_id ORDER BY ts RANGE BETWEEN INTERVAL 48 HOURS PRECEDING
    AND INTERVAL 1 MICROSECOND PRECEDING)"""


@registered(_trailing_sql(_BY_ROWS, "power_kw_roll_4"))
def rolling_rows_with_nan(spark, folder):
    df = m.rolling_rows(_with_nan(spark, folder), n=4, stats=_ALL, order=ORDER, scale=2)
    return rounded(_keyed(df), ["power_kw_roll_4_std"])


@registered(_trailing_sql(_BY_TIME, "power_kw_48_hours"))
def rolling_time_with_nan(spark, folder):
    df = m.rolling_time(_with_nan(spark, folder), width="48 hours", scale=2)
    return rounded(_keyed(df), ["power_kw_48_hours_std"])


@registered(
    f"""WITH {READINGS_NULL}
    SELECT 'power_kw' AS a, 'event_id' AS b, count(power_kw) AS n,
           {round_sql("corr(power_kw, event_id)", "corr")} FROM readings"""
)
def correlations_with_nan(spark, folder):
    return rounded(m.correlations(_with_nan(spark, folder), pairs=[("power_kw", "event_id")]), ["corr"])


def _shifted(spark, folder):
    """Readings whose level is 60 more in the second week and 120 more from 2024-01-20 on."""
    df = readings(spark, folder)
    day = F.to_date("ts")
    up = F.when(day >= F.lit("2024-01-20").cast("date"), 120.0).when(day >= F.lit("2024-01-08").cast("date"), 60.0).otherwise(0.0)
    # Rounded digits of the key as noise, so that both engines see the same numbers.
    noise = (F.col("event_id") * 7919 % 101).cast("double") / 10
    return df.withColumn("power_kw", up + noise)


_SHIFTED = f"""WITH {READINGS}, leveled AS (
      SELECT CAST(0 AS BIGINT) AS meter_id, event_id, ts,
             CASE WHEN ts >= DATE '2024-01-20' THEN 120.0 WHEN ts >= DATE '2024-01-08' THEN 60.0 ELSE 0.0 END::DOUBLE
               + (event_id * 7919 % 101)::DOUBLE / 10 AS x,
             CASE WHEN ts >= DATE '2024-01-20' THEN 2 WHEN ts >= DATE '2024-01-08' THEN 1 ELSE 0 END AS part
      FROM readings)"""


@registered(
    _SHIFTED
    + f""", parts AS (SELECT meter_id, part, min(ts) AS ts, avg(x) AS m FROM leveled GROUP BY ALL),
    looked AS (SELECT *, lag(m) OVER (ORDER BY part) AS before FROM parts)
    SELECT meter_id, ts, {round_sql("before", "mean_before", 5)}, {round_sql("m", "mean_after", 5)} FROM looked WHERE part > 0"""
)
def change_points_one_meter(spark, folder):
    """The two planted shifts, and no other, over many blocks."""
    df = _shifted(spark, folder).withColumn("meter_id", F.lit(0).cast("bigint"))
    found = m.change_points(df, order=ORDER, block_rows=BLOCK_ROWS)
    return rounded(found, ["mean_before", "mean_after"], 5)


def _hourly_sums(spark, folder):
    return m.regular_grid(one_meter(spark, folder), "hour", aggs=("sum",), scale=2).select("meter_id", "bucket", "power_kw_sum")


_HALF = "OVER (ORDER BY bucket ROWS BETWEEN {0} AND {1})"


@registered(
    f"""WITH {ONE_METER}, sums AS (
      SELECT date_trunc('hour', ts) AS bucket, CAST(sum(CAST(power_kw AS DECIMAL(18,2))) AS DOUBLE) AS v FROM readings GROUP BY ALL),
    ends AS (SELECT min(bucket) AS a, max(bucket) AS b FROM sums),
    grid AS (
      SELECT g AS bucket, v FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS g FROM ends)
      LEFT JOIN sums ON g = bucket),
    trended AS (
      SELECT bucket, v,
        CASE WHEN count(*) {_HALF.format("12 PRECEDING", "13 FOLLOWING")} = 26
          THEN (avg(v) {_HALF.format("12 PRECEDING", "11 FOLLOWING")} + avg(v) {_HALF.format("11 PRECEDING", "12 FOLLOWING")}) / 2 END AS trend
      FROM grid),
    phased AS (SELECT *, avg(v - trend) OVER (PARTITION BY hour(bucket)) AS away FROM trended),
    phases AS (SELECT avg(away) AS mean FROM (SELECT DISTINCT hour(bucket) AS h, away FROM phased)),
    found AS (SELECT bucket, v, trend, away - mean AS season FROM phased, phases)
    SELECT bucket, {round_sql("trend", "trend", 7)}, {round_sql("season", "season", 7)},
           {round_sql("v - trend - season", "rest", 7)} FROM found"""
)
def decompose(spark, folder):
    """Trend, season of a day and rest of the hourly totals of all meters."""
    found = m.decompose(_hourly_sums(spark, folder), "power_kw_sum", 24)
    names = {f"power_kw_sum_{c}": c for c in ("trend", "season", "rest")}
    return rounded(found.withColumnsRenamed(names).select("bucket", *names.values()), ["trend", "season", "rest"], 7)


@registered(
    f"""WITH {READINGS_NULL}
    SELECT count(power_kw) AS n, min(power_kw) AS low, max(power_kw) AS high, true AS near_quantiles, true AS near_distinct
    FROM readings"""
)
def merged_sketches(spark, folder):
    """Sketches per date, merged: quantiles within two per cent of their rank, distinct meters within three."""
    df = readings_null(spark, folder)
    shares = (0.05, 0.25, 0.5, 0.75, 0.95)
    table = m.sketch_table(df)
    told = m.sketched(m.merge_sketches(table), shares).first()
    named = {f"q{q * 100:g}": q for q in shares}
    below = lambda c: F.avg(F.when(F.col("power_kw").isNotNull(), (F.col("power_kw") <= told[c]).cast("double")))
    near = reduce(Column.__and__, [F.abs(below(c) - q) <= 0.02 for c, q in named.items()])
    meters = F.countDistinct("meter_id")
    return df.agg(
        F.lit(told["n"]).cast("bigint").alias("n"), F.lit(told["low"]).alias("low"), F.lit(told["high"]).alias("high"),
        near.alias("near_quantiles"), (F.abs(told["distinct_ids"] - meters) <= 0.03 * meters).alias("near_distinct"),
    )


def _loaded(spark, folder):
    """A stored table without every fifth reading, and those, late, with corrections of others."""
    df, key = readings(spark, folder), F.col("event_id")
    path = scratch_path(spark, "loaded")
    m.write_table(df.where(key % 5 != 0), path, sort_by=ORDER)
    late = df.where((key % 5 == 0) & (F.dayofmonth("ts") < 20))
    fixed = df.where((key % 11 == 1) & (F.dayofmonth("ts") == 3)).withColumn("power_kw", F.col("power_kw") + 1)
    return path, late.unionByName(fixed)


_MERGED = f"""WITH {READINGS}, merged AS (
      SELECT event_id, meter_id, ts, power_kw + CASE WHEN event_id % 11 = 1 AND day(ts) = 3 THEN 1 ELSE 0 END AS power_kw
      FROM readings WHERE event_id % 5 <> 0 OR day(ts) < 20 OR (event_id % 11 = 1 AND day(ts) = 3))"""


@registered(_MERGED + " SELECT event_id, meter_id, ts, power_kw FROM merged")
def merge_readings(spark, folder):
    """Late and corrected readings merged into a stored table equal a full load."""
    path, new = _loaded(spark, folder)
    m.merge_readings(spark, path, new, sort_by=ORDER)
    return spark.read.parquet(path).select("event_id", "meter_id", "ts", "power_kw")


@registered(
    _MERGED
    + """ SELECT event_id, lag(power_kw) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS power_kw_lag_1,
      lag(power_kw, 2) OVER (PARTITION BY meter_id ORDER BY ts, event_id) AS power_kw_lag_2 FROM merged"""
)
def refresh_features(spark, folder):
    """Features recomputed from each meter's first change on equal those of the whole merged table."""
    path, new = _loaded(spark, folder)
    make = lambda df: m.lag_features(df, lags=(1, 2), order=ORDER)
    features = scratch_path(spark, "features")
    m.write_table(make(spark.read.parquet(path).drop("date")), features, sort_by=ORDER)
    m.merge_readings(spark, path, new, sort_by=ORDER)
    m.refresh_features(spark, spark.read.parquet(path).drop("date"), features, new, make, reach=2, order=ORDER)
    return spark.read.parquet(features).select("event_id", "power_kw_lag_1", "power_kw_lag_2")


_SERIES = "OVER (PARTITION BY meter_id ORDER BY ts, event_id)"


@registered(
    f"""WITH {ONE_METER_NULL} SELECT event_id, lag(power_kw, 2) {_SERIES} AS power_kw_lag_2,
      lag(power_kw, 700) {_SERIES} AS power_kw_lag_700 FROM readings"""
)
def lag_features_beyond_a_block(spark, folder):
    """A lag longer than the blocks that the series is cut into, beside a short one."""
    df = m.lag_features(one_meter_null(spark, folder), lags=(2, 700), order=ORDER, block_rows=BLOCK_ROWS // 10)
    return _keyed(df)
