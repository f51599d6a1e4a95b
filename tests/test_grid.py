import pytest
from pyspark.sql import functions as F
from tiny import at, by_key, table

import meterlab as m
from meterlab.operators import grid as grid_module

ROWS = [
    (1, "2024-01-01 22:10:00", 1.0),
    (1, "2024-01-01 22:50:00", 3.0),
    (1, "2024-01-02 01:00:00", 5.0),
    (2, "2024-01-01 00:00:00", None),
    (None, "2024-01-01 00:00:00", 7.0),
    (None, "2024-01-01 02:59:59", 9.0),
    (1, None, 11.0),
]


def cells(df, *cols):
    return {(r.meter_id, r.bucket): tuple(r[c] for c in cols) for r in df.collect()}


def test_resample_keeps_readings_without_time_apart(spark):
    got = cells(m.resample(table(spark, ROWS)), "n_readings", "power_kw_sum", "power_kw_mean")
    assert got[1, at("2024-01-01 22:00:00")] == (2, 4.0, 2.0)
    assert got[1, None] == (1, 11.0, 11.0)
    assert got[2, at("2024-01-01 00:00:00")] == (1, None, None)


def test_grid_has_every_step_once(spark):
    df = m.regular_grid(table(spark, ROWS), aggs=("sum", "max"))
    got = cells(df, "n_readings", "power_kw_sum", "power_kw_max")
    assert got == {
        (1, at("2024-01-01 22:00:00")): (2, 4.0, 3.0),
        (1, at("2024-01-01 23:00:00")): (0, None, None),
        (1, at("2024-01-02 00:00:00")): (0, None, None),
        (1, at("2024-01-02 01:00:00")): (1, 5.0, 5.0),
        (2, at("2024-01-01 00:00:00")): (1, None, None),
        (None, at("2024-01-01 00:00:00")): (1, 7.0, 7.0),
        (None, at("2024-01-01 01:00:00")): (0, None, None),
        (None, at("2024-01-01 02:00:00")): (1, 9.0, 9.0),
    }
    assert df.count() == len(got)


def test_grid_is_the_same_in_small_chunks(spark, monkeypatch):
    df = table(spark, [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-03 05:00:00", 2.0)])
    whole = cells(m.regular_grid(df), "n_readings")
    monkeypatch.setattr(grid_module, "_CHUNK", 7)
    assert cells(m.regular_grid(df), "n_readings") == whole
    assert len(whole) == 54


def test_long_gaps_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(grid_module, "_STEPS_PER_TASK", 1_000_000)
    df = table(spark, [(1, "2004-01-01 00:00:00", 1.0), (1, "2024-01-01 00:00:00", 2.0)])
    grid = m.regular_grid(df, "minute", aggs=("max",))
    held = grid.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 20 * 365 * 1440 + 5 * 1440 + 1
    assert len(held) >= 6 and max(r["count"] for r in held) < 4_000_000


def test_grid_reads_its_input_once(spark, capsys):
    m.regular_grid(table(spark, ROWS)).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan.split("Initial Plan")[0]


def test_grid_of_months_over_years_and_of_nothing(spark):
    df = table(spark, [(1, "2023-11-30 00:00:00", 1.0), (1, "2024-02-29 00:00:00", 2.0)])
    months = sorted(b for _, b in cells(m.regular_grid(df, "month"), "n_readings"))
    assert months == [at(f"{d} 00:00:00") for d in ("2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01")]
    assert m.regular_grid(table(spark, [])).count() == 0
    assert m.regular_grid(table(spark, []), by=()).count() == 0


def test_grid_without_a_key(spark):
    df = m.regular_grid(table(spark, ROWS).where("meter_id = 1"), by=())
    assert {r.bucket: r.n_readings for r in df.collect()}[at("2024-01-02 00:00:00")] == 0


@pytest.mark.parametrize("unique", [False, True])
def test_seasonal_lag_and_direct_label(spark, unique):
    df = m.regular_grid(table(spark, ROWS), aggs=("max",))
    df = m.seasonal_lag(df, "power_kw_max", "2 hours", ts="bucket", unique=unique)
    df = m.direct_label(df, "power_kw_max", 3, unique=unique)
    got = cells(df, "power_kw_max_2_hours_ago", "label")
    assert len(got) == df.count() == 8
    assert got[None, at("2024-01-01 02:00:00")] == (7.0, None)
    assert got[1, at("2024-01-02 00:00:00")] == (3.0, None)
    assert got[1, at("2024-01-01 22:00:00")] == (None, 5.0)


def test_seasonal_lag_keeps_every_row(spark):
    df = table(spark, ROWS).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    assert m.seasonal_lag(df).count() == m.seasonal_lag(df, unique=True).count() == 21
    assert set(by_key(m.seasonal_lag(df, period="150 minutes"), "power_kw_150_minutes_ago")) == set(range(7))


@pytest.mark.parametrize("unique", [False, True])
def test_readings_at_equal_times_count_with_their_mean(spark, unique):
    rows = [(1, "2024-01-01 00:00:00", 2.0), (1, "2024-01-01 00:00:00", 4.0)]
    rows += [(1, "2024-01-02 00:00:00", v) for v in (5.0, None)]
    got = by_key(m.seasonal_lag(table(spark, rows), unique=unique), "power_kw", "power_kw_24_hours_ago")
    assert got == {0: (2.0, None), 1: (4.0, None), 2: (5.0, 3.0), 3: (None, 3.0)}
