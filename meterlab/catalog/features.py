"""Time features, steps and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

import meterlab as m
from meterlab.catalog.fixtures import (
    DAILY_ORDERS,
    ONE_METER,
    ORDER,
    READINGS,
    READINGS_NULL,
    daily_orders,
    one_meter,
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
from meterlab.functions import bucket

# Small enough that the given tables fill many blocks.
BLOCK_ROWS = 2_000

_CALENDAR = """WITH {0}
    SELECT event_id, CAST(year(ts) AS BIGINT) AS year, CAST(quarter(ts) AS BIGINT) AS quarter,
           CAST(month(ts) AS BIGINT) AS month, CAST(day(ts) AS BIGINT) AS day,
           CAST(hour(ts) AS BIGINT) AS hour, CAST(minute(ts) AS BIGINT) AS minute,
           CAST(isodow(ts) - 1 AS BIGINT) AS weekday,
           CAST(dayofyear(ts) AS BIGINT) AS day_of_year, CAST(week(ts) AS BIGINT) AS week
    FROM readings"""


def _keyed(df, *extra):
    """The row key and the columns that an operator added."""
    added = [c for c in df.columns if c not in ("meter_id", "ts", "power_kw", "channel")]
    return df.select(*added, *extra)


@registered(_CALENDAR.format(READINGS))
def calendar_features(spark, folder):
    return long_ints(_keyed(m.calendar_features(readings(spark, folder))))


@registered(_CALENDAR.format(DAILY_ORDERS))
def calendar_features_of_orders(spark, folder):
    return long_ints(_keyed(m.calendar_features(daily_orders(spark, folder))))


@registered(
    f"""WITH {READINGS}
    SELECT event_id, CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
           CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
                WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END AS day_part
    FROM readings"""
)
def calendar_flags(spark, folder):
    return long_ints(_keyed(m.calendar_flags(readings(spark, folder))))


_CYCLES = ",\n".join(
    round_sql(f"{f}(2 * pi() * {part} / {length}.0)", f"{name}_{f}")
    for name, part, length in (
        ("hour", "hour(ts)", 24),
        ("weekday", "(isodow(ts) - 1)", 7),
        ("month", "(month(ts) - 1)", 12),
    )
    for f in ("sin", "cos")
)


@registered(f"WITH {READINGS} SELECT event_id, {_CYCLES} FROM readings")
def cyclic_features(spark, folder):
    df = _keyed(m.cyclic_features(readings(spark, folder)))
    return rounded(df, df.columns[1:])


_SERIES = "OVER (PARTITION BY meter_id ORDER BY ts, event_id)"
_LAST = (
    "OVER (PARTITION BY meter_id ORDER BY ts, event_id "
    "ROWS BETWEEN {0} PRECEDING AND 1 PRECEDING)"
)

_LAGS = f"""WITH {{0}}
    SELECT event_id, lag(power_kw, 1) {_SERIES} AS power_kw_lag_1,
           lag(power_kw, 2) {_SERIES} AS power_kw_lag_2,
           lag(power_kw, 24) {_SERIES} AS power_kw_lag_24
    FROM readings"""


@registered(_LAGS.format(READINGS))
def lag_features(spark, folder):
    return _keyed(m.lag_features(readings(spark, folder), lags=(1, 2, 24), order=ORDER))


@registered(_LAGS.format(ONE_METER))
def lag_features_one_meter(spark, folder):
    df = one_meter(spark, folder)
    return _keyed(m.lag_features(df, lags=(1, 2, 24), order=ORDER, block_rows=BLOCK_ROWS))


def _rolling_sql(table: str, n: int) -> str:
    frame = _LAST.format(n)
    value = "CAST(power_kw AS DECIMAL(18,2))"
    mean = f"CAST(sum({value}) {frame} AS DOUBLE) / nullif(count(power_kw) {frame}, 0)"
    return f"""WITH {table}
    SELECT event_id, {mean} AS power_kw_roll_{n}_mean,
           {round_sql(f"stddev_samp(power_kw) {frame}", f"power_kw_roll_{n}_std")},
           min(power_kw) {frame} AS power_kw_roll_{n}_min,
           max(power_kw) {frame} AS power_kw_roll_{n}_max
    FROM readings"""


@registered(_rolling_sql(READINGS, 3))
def rolling_rows(spark, folder):
    df = _keyed(m.rolling_rows(readings(spark, folder), n=3, order=ORDER, scale=2))
    return rounded(df, ["power_kw_roll_3_std"])


@registered(_rolling_sql(READINGS_NULL, 5))
def rolling_rows_with_nulls(spark, folder):
    df = _keyed(m.rolling_rows(readings_null(spark, folder), n=5, order=ORDER, scale=2))
    return rounded(df, ["power_kw_roll_5_std"])


@registered(_rolling_sql(ONE_METER, 10))
def rolling_rows_one_meter(spark, folder):
    df = one_meter(spark, folder)
    df = m.rolling_rows(df, n=10, order=ORDER, scale=2, block_rows=BLOCK_ROWS)
    return rounded(_keyed(df), ["power_kw_roll_10_std"])


@registered(_rolling_sql(ONE_METER, 1_000))
def rolling_many_rows_one_meter(spark, folder):
    df = one_meter(spark, folder)
    df = m.rolling_rows(df, n=1_000, order=ORDER, scale=2, block_rows=BLOCK_ROWS)
    return rounded(_keyed(df), ["power_kw_roll_1000_std"])


_ALL = ("count", "sum", "mean", "std", "min", "max")


def _all_rows_sql(n: int) -> str:
    frame = f"OVER (PARTITION BY meter_id ORDER BY ts, event_id ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    name = f"power_kw_roll_{n}"
    total = f"CAST(sum(CAST(power_kw AS DECIMAL(18,2))) {frame} AS DOUBLE)"
    return f"""count(power_kw) {frame} AS {name}_count, {total} AS {name}_sum,
           {total} / nullif(count(power_kw) {frame}, 0) AS {name}_mean,
           {round_sql(f"stddev_samp(power_kw) {frame}", f"{name}_std")},
           min(power_kw) {frame} AS {name}_min, max(power_kw) {frame} AS {name}_max"""


@registered(f"WITH {ONE_METER} SELECT event_id, {_all_rows_sql(3)}, {_all_rows_sql(300)} FROM readings")
def rolling_rows_all_stats(spark, folder):
    """All statistics over few and over many rows: same names, same definitions."""
    df = m.history_features(
        one_meter(spark, folder), lags=(), rolling=(3, 300), stats=_ALL, order=ORDER, scale=2,
        block_rows=BLOCK_ROWS,
    )
    return rounded(_keyed(df), ["power_kw_roll_3_std", "power_kw_roll_300_std"])


def _rolling_time_sql(table: str, width: str) -> str:
    frame = (
        f"OVER (PARTITION BY meter_id ORDER BY ts RANGE BETWEEN INTERVAL {width} PRECEDING "
        "AND INTERVAL 1 MICROSECOND PRECEDING)"
    )
    name = f"power_kw_{'_'.join(width.split())}"
    total = f"CAST(sum(CAST(power_kw AS DECIMAL(18,2))) {frame} AS DOUBLE)"
    return f"""WITH {table}
    SELECT event_id, count(power_kw) {frame} AS {name}_count, {total} AS {name}_sum,
           {total} / nullif(count(power_kw) {frame}, 0) AS {name}_mean,
           {round_sql(f"stddev_samp(power_kw) {frame}", f"{name}_std")},
           min(power_kw) {frame} AS {name}_min, max(power_kw) {frame} AS {name}_max
    FROM readings"""


@registered(_rolling_time_sql(READINGS, "24 hours"))
def rolling_time(spark, folder):
    df = _keyed(m.rolling_time(readings(spark, folder), scale=2))
    return rounded(df, ["power_kw_24_hours_std"])


@registered(_rolling_time_sql(READINGS_NULL, "7 days"))
def rolling_time_week(spark, folder):
    df = _keyed(m.rolling_time(readings_null(spark, folder), width="7 days", scale=2))
    return rounded(df, ["power_kw_7_days_std"])


@registered(_rolling_time_sql(ONE_METER, "7 days"))
def rolling_time_one_meter(spark, folder):
    df = one_meter(spark, folder)
    df = m.rolling_time(df, width="7 days", scale=2, block_rows=BLOCK_ROWS)
    return rounded(_keyed(df), ["power_kw_7_days_std"])


_DELTA = f"""WITH {{0}}
    SELECT event_id, {round_sql(f"power_kw - lag(power_kw) {_SERIES}", "power_kw_delta")},
           date_sub('second', lag(ts) {_SERIES}, ts) AS seconds_since_previous
    FROM readings"""


def _changes(df):
    return rounded(_keyed(df), ["power_kw_delta"])


@registered(_DELTA.format(READINGS))
def delta_features(spark, folder):
    return _changes(m.delta_features(readings(spark, folder), order=ORDER))


@registered(_DELTA.format(ONE_METER))
def delta_features_one_meter(spark, folder):
    return _changes(
        m.delta_features(one_meter(spark, folder), order=ORDER, block_rows=BLOCK_ROWS)
    )


@registered(
    f"""WITH {READINGS}
    SELECT event_id, lag(power_kw, 1) {_SERIES} AS power_kw_lag_1,
           CAST(sum(CAST(power_kw AS DECIMAL(18,2))) {_LAST.format(3)} AS DOUBLE)
             / nullif(count(power_kw) {_LAST.format(3)}, 0) AS power_kw_roll_3_mean,
           max(power_kw) {_LAST.format(24)} AS power_kw_roll_24_max,
           {round_sql(f"power_kw - lag(power_kw) {_SERIES}", "power_kw_delta")}
    FROM readings"""
)
def history_features(spark, folder):
    """Several history features from one shuffle and one sort."""
    df = m.history_features(
        readings(spark, folder),
        lags=(1,),
        rolling=(3, 24),
        stats=("mean", "max"),
        delta=True,
        order=ORDER,
        scale=2,
    )
    wanted = ["power_kw_lag_1", "power_kw_roll_3_mean", "power_kw_roll_24_max", "power_kw_delta"]
    return rounded(df.select("event_id", *wanted), ["power_kw_delta"])


_STEP = f"""WITH {{0}}
    SELECT meter_id, date_trunc('{{1}}', ts) AS bucket, count(*) AS n_readings,
           {exact_sum("power_kw")} AS power_kw_sum, {exact_mean("power_kw")} AS power_kw_mean,
           min(power_kw) AS power_kw_min, max(power_kw) AS power_kw_max
    FROM readings GROUP BY 1, 2"""


@registered(_STEP.format(READINGS, "hour"))
def resample_hour(spark, folder):
    return m.resample(readings(spark, folder), "hour", scale=2)


@registered(_STEP.format(READINGS, "day"))
def resample_day(spark, folder):
    return m.resample(readings(spark, folder), "day", scale=2)


@registered(_STEP.format(DAILY_ORDERS, "week"))
def resample_week(spark, folder):
    return m.resample(daily_orders(spark, folder), "week", scale=2).withColumn(
        "bucket", F.col("bucket").cast("timestamp_ntz")
    )


@registered(
    f"""WITH {READINGS}
    SELECT meter_id, time_bucket(INTERVAL '15 minutes', ts) AS bucket, count(*) AS n_readings,
           max(power_kw) AS power_kw_max
    FROM readings GROUP BY 1, 2"""
)
def resample_quarter_hour(spark, folder):
    return m.resample(readings(spark, folder), "15 minutes", aggs=("max",))


def _grid_sql(table: str, step: str) -> str:
    """A WITH list that ends in ``grid``."""
    return f"""{table}, steps AS (
      SELECT meter_id, date_trunc('{step}', ts) AS bucket, count(*) AS n_readings,
             {exact_sum("power_kw")} AS power_kw_sum, {exact_mean("power_kw")} AS power_kw_mean,
             min(power_kw) AS power_kw_min, max(power_kw) AS power_kw_max
      FROM readings GROUP BY 1, 2),
    bounds AS (
      SELECT meter_id,
             unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 {step})) AS bucket
      FROM steps GROUP BY meter_id),
    grid AS (
      SELECT meter_id, bucket, coalesce(n_readings, 0) AS n_readings, power_kw_sum, power_kw_mean,
             power_kw_min, power_kw_max
      FROM bounds LEFT JOIN steps USING (meter_id, bucket))"""


@registered(f"WITH {_grid_sql(READINGS, 'hour')} SELECT * FROM grid")
def regular_grid(spark, folder):
    return m.regular_grid(readings(spark, folder), "hour", scale=2)


@registered(f"WITH {_grid_sql(ONE_METER, 'minute')} SELECT * FROM grid")
def regular_grid_one_meter(spark, folder):
    return m.regular_grid(one_meter(spark, folder), "minute", scale=2)


@registered(f"WITH {_grid_sql(DAILY_ORDERS, 'month')} SELECT * FROM grid")
def regular_grid_month(spark, folder):
    return m.regular_grid(daily_orders(spark, folder), "month", scale=2)


def _hourly(spark, folder):
    return m.regular_grid(readings(spark, folder), "hour", aggs=("max",))


_SEASON = f"""WITH {_grid_sql(READINGS, "hour")}
    SELECT meter_id, bucket, n_readings, power_kw_max,
           lag(power_kw_max, {{0}}) OVER (PARTITION BY meter_id ORDER BY bucket)
             AS power_kw_max_{{1}}_ago
    FROM grid"""


@registered(_SEASON.format(24, "24_hours"))
def seasonal_lag_day(spark, folder):
    grid = _hourly(spark, folder)
    return m.seasonal_lag(grid, "power_kw_max", "24 hours", ts="bucket", unique=True)


@registered(_SEASON.format(168, "7_days"))
def seasonal_lag_week(spark, folder):
    grid = _hourly(spark, folder)
    return m.seasonal_lag(grid, "power_kw_max", "7 days", ts="bucket", unique=True)


@registered(
    f"""WITH {READINGS}, hours AS (
      SELECT event_id, meter_id, date_trunc('hour', ts) AS ts, power_kw FROM readings), means AS (
      SELECT meter_id, ts + INTERVAL 24 HOURS AS ts, avg(power_kw) AS ago
      FROM hours GROUP BY meter_id, ts)
    SELECT event_id, {round_sql("ago", "power_kw_24_hours_ago")}
    FROM hours LEFT JOIN means USING (meter_id, ts)"""
)
def seasonal_lag_of_repeated_times(spark, folder):
    """Readings by the hour: times repeat, and the mean of an hour is its value."""
    hours = readings(spark, folder).withColumn("ts", bucket(F.col("ts"), "hour"))
    df = m.seasonal_lag(hours, "power_kw", "24 hours")
    return rounded(df.select("event_id", "power_kw_24_hours_ago"), ["power_kw_24_hours_ago"])


def _monthly(spark, folder):
    return m.regular_grid(daily_orders(spark, folder), "month", aggs=("max",))


@registered(
    f"""WITH {_grid_sql(DAILY_ORDERS, "month")}
    SELECT meter_id, bucket, n_readings, power_kw_max,
           lag(power_kw_max, 12) OVER (PARTITION BY meter_id ORDER BY bucket)
             AS power_kw_max_1_year_ago
    FROM grid"""
)
def seasonal_lag_year(spark, folder):
    grid = _monthly(spark, folder)
    return m.seasonal_lag(grid, "power_kw_max", "1 year", ts="bucket", unique=True)


@registered(
    f"""WITH {_grid_sql(DAILY_ORDERS, "month")}
    SELECT meter_id, bucket, n_readings, power_kw_max,
           lead(power_kw_max, 2) OVER (PARTITION BY meter_id ORDER BY bucket) AS label
    FROM grid"""
)
def direct_label_month(spark, folder):
    return m.direct_label(_monthly(spark, folder), "power_kw_max", 2, "month", unique=True)
