import math

import pytest
from tiny import at, by_key, table

import meterlab as m

ROWS = [
    (1, "2024-01-01 00:00:00", 1.0),
    (1, "2024-01-01 01:00:00", 3.0),
    (1, "2024-01-01 01:00:00.500", None),
    (1, "2024-01-02 00:30:00", 8.0),
    (2, "2024-01-01 00:00:00", 5.0),
    (None, "2024-01-01 00:00:00", 6.0),
    (None, "2024-01-01 00:00:01", 7.0),
]


def test_calendar_parts_at_the_edges_of_years(spark):
    df = table(spark, [(1, t, 1.0) for t in ("2024-02-29 23:59:59", "2024-12-31 00:00:00", "2023-01-01 12:05:00")])
    df = m.calendar_features(df)
    cols = ("year", "quarter", "month", "day", "hour", "minute", "weekday", "day_of_year", "week")
    assert by_key(df, *cols) == {
        0: (2024, 1, 2, 29, 23, 59, 3, 60, 9),
        1: (2024, 4, 12, 31, 0, 0, 1, 366, 1),
        2: (2023, 1, 1, 1, 12, 5, 6, 1, 52),
    }


def test_calendar_flags(spark):
    df = table(spark, [(1, t, 1.0) for t in ("2024-01-06 05:59:59", "2024-01-05 06:00:00", "2024-01-07 12:00:00", "2024-01-08 18:00:00", None)])
    assert by_key(m.calendar_flags(df), "is_weekend", "day_part") == {
        0: (1, "night"), 1: (0, "morning"), 2: (1, "afternoon"), 3: (0, "evening"), 4: (None, None),
    }


def test_cyclic_features_join_the_ends_of_the_day(spark):
    df = m.cyclic_features(table(spark, [(1, "2024-01-01 23:00:00", 1.0), (1, "2024-01-01 00:00:00", 1.0)]))
    got = by_key(df, "hour_sin", "hour_cos", "weekday_sin", "month_cos")
    assert math.dist(got[0][:2], got[1][:2]) < 0.27
    assert got[1] == (0.0, 1.0, 0.0, 1.0)


def test_lag_delta_and_elapsed_time(spark):
    df = table(spark, ROWS)
    lags = by_key(m.lag_features(df, lags=(1, 2)), "power_kw_lag_1", "power_kw_lag_2")
    assert lags[1] == (1.0, None) and lags[3] == (None, 3.0) and lags[4] == (None, None)
    assert lags[6] == (6.0, None)
    deltas = by_key(m.delta_features(df), "power_kw_delta", "seconds_since_previous")
    assert deltas[1] == (2.0, 3600) and deltas[2] == (None, 0) and deltas[3] == (None, 84599)
    assert deltas[0] == (None, None)


def test_rolling_rows_leaves_the_current_reading_out(spark):
    got = by_key(m.rolling_rows(table(spark, ROWS), n=2), *[f"power_kw_roll_2_{s}" for s in ("mean", "std", "min", "max")])
    assert got[0] == (None, None, None, None)
    assert got[1] == (1.0, None, 1.0, 1.0)
    assert got[2] == (2.0, math.sqrt(2), 1.0, 3.0)
    assert got[3] == (3.0, None, 3.0, 3.0)


@pytest.mark.parametrize("block_rows", [1_000_000, 1])
def test_rolling_time_frame_includes_its_start_and_not_its_end(spark, block_rows):
    rows = [
        (1, "2024-01-01 00:00:00", 1.0),
        (1, "2024-01-01 12:00:00", 3.0),
        (1, "2024-01-02 00:00:00", 5.0),
        (1, "2024-01-02 00:00:00", 7.0),
        (1, "2024-01-02 00:00:00.000001", None),
        (1, None, 9.0),
        (2, "2024-01-02 00:00:00", 9.0),
        (None, "1969-12-31 23:00:00", 2.0),
        (None, "1970-01-01 01:00:00", 4.0),
    ]
    df = m.rolling_time(table(spark, rows), block_rows=block_rows)
    cols = [f"power_kw_24_hours_{s}" for s in ("count", "sum", "mean", "std", "min", "max")]
    got = by_key(df, *cols)
    assert got[0] == (0, None, None, None, None, None)
    assert got[1] == (1, 1.0, 1.0, None, 1.0, 1.0)
    assert got[2] == got[3] == (2, 4.0, 2.0, math.sqrt(2), 1.0, 3.0)
    assert got[4] == (3, 15.0, 5.0, 2.0, 3.0, 7.0)
    assert got[5] == (None,) * 6
    assert got[6] == got[7] == got[0]
    assert got[8] == (1, 2.0, 2.0, None, 2.0, 2.0)


def test_std_of_a_constant_series_far_from_the_mean_is_zero(spark):
    rows = [(1, f"2024-01-01 0{h}:00:00", 1e9 + 0.1) for h in range(5)]
    rows += [(2, f"2024-01-01 0{h}:00:00", 0.5) for h in range(5)]
    for block_rows in (1_000_000, 1):
        df = m.rolling_time(table(spark, rows), stats=("std",), block_rows=block_rows)
        assert by_key(df, "power_kw_24_hours_std")[4] == 0.0
        assert by_key(df, "power_kw_24_hours_std")[9] == 0.0


def test_unknown_statistic_and_step_are_refused(spark):
    with pytest.raises(ValueError, match="median"):
        m.rolling_time(table(spark, ROWS), stats=("median",))
    for step in ("fortnight", "0 hours", "2 months", "hour glass now"):
        with pytest.raises(ValueError):
            m.resample(table(spark, ROWS), step)


def test_time_arithmetic_inverts(spark):
    from pyspark.sql import functions as F

    from meterlab.functions import bucket, from_micros, micros

    times = ["1883-11-18 12:03:58.000001", "1969-12-31 23:59:59.999999", "2024-03-10 02:30:00", "9999-12-31 23:59:59"]
    df = table(spark, [(1, t, 1.0) for t in times])
    assert by_key(df.withColumn("x", from_micros(micros(F.col("ts")))), "x") == {
        i: at(t) for i, t in enumerate(times)
    }
    steps = df.select("event_id", *[bucket(F.col("ts"), s).alias(s.replace(" ", "_")) for s in ("15 minutes", "hour", "week", "2 hours", "quarter")])
    assert by_key(steps, "15_minutes", "hour", "week", "2_hours", "quarter")[2] == (
        at("2024-03-10 02:30:00"), at("2024-03-10 02:00:00"), at("2024-03-04 00:00:00"),
        at("2024-03-10 02:00:00"), at("2024-01-01 00:00:00"),
    )
    assert by_key(steps, "week")[1] == at("1969-12-29 00:00:00")
