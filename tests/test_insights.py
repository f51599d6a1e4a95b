"""Change points, decomposition, sketches, search with early stop, and incremental loads."""

import glob
import math
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import meterlab as m
from meterlab.catalog.fixtures import CUTOFF, readings_signal

START = datetime(2024, 1, 1)


def series(spark, meters):
    """Rows (event_id, meter_id, ts, power_kw), one a minute, of lists of values."""
    rows = [(i, k, START + timedelta(minutes=i), v) for k, values in meters.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, meter_id long, ts timestamp_ntz, power_kw double")


def segments(values, penalty=10.0, least=5):
    """Binary segmentation by plain sums of squares."""
    if len(values) < 2:
        return []
    steps = sorted(abs(b - a) for a, b in zip(values, values[1:], strict=False))
    mean = sum(values) / len(values)
    noise = max((steps[(len(steps) + 1) // 2 - 1] / 0.9538725524) ** 2, 1e-9 * sum((v - mean) ** 2 for v in values) / len(values))
    limit, cuts, open_ = penalty * math.log(len(values)) * noise, set(), [(0, len(values))]
    while open_:
        a, b = open_.pop()
        spread = lambda x: sum((v - sum(x) / len(x)) ** 2 for v in x)
        whole, best = spread(values[a:b]), None
        for c in range(a + least, b - least + 1):
            gain = whole - spread(values[a:c]) - spread(values[c:b])
            if gain > limit and (best is None or gain > best[0] + 1e-9):
                best = (gain, c)
        if best:
            cuts.add(best[1])
            open_ += [(a, best[1]), (best[1], b)]
    return sorted(cuts)


@pytest.mark.parametrize("block_rows", [10**6, 25])
def test_change_points_equal_a_plain_search(spark, block_rows):
    draw = random.Random(4)
    level = lambda *parts: [draw.gauss(mean, 1) for mean, count in parts for _ in range(count)]
    meters = {
        1: level((0, 60), (10, 40), (10_000, 30), (9_990, 20)), 2: level((5, 50)), 3: level((0, 12), (50, 5), (0, 12)),
        4: [7.0] * 20, 5: [1.0], 6: [None, float("nan")] * 3,
    }
    found = m.change_points(series(spark, meters), order=("ts", "event_id"), block_rows=block_rows)
    rows = {}
    for r in found.collect():
        rows.setdefault(r.meter_id, []).append((int((r.ts - START).total_seconds() / 60), r.mean_before, r.mean_after))
    for k, values in meters.items():
        known = [v for v in values if v is not None and v == v]
        cuts = segments(known)
        told = sorted(rows.get(k, []))
        assert [at for at, *_ in told] == cuts, k
        edges = [0, *cuts, len(known)] if known else [0]
        means = [sum(known[a:b]) / (b - a) for a, b in zip(edges, edges[1:], strict=False)]
        means = means or [0]
        assert [x for _, x, _ in told] == pytest.approx(means[:-1]) and [x for *_, x in told] == pytest.approx(means[1:])
    assert len(rows[1]) == 3 and 2 not in rows and 4 not in rows


@pytest.mark.parametrize(("period", "block_rows"), [(4, 10**6), (5, 10**6), (4, 30), (5, 30)])
def test_decompose_adds_up(spark, period, block_rows):
    wave = [0.0, 3.0, 1.0, -4.0, 2.0][:period]
    mean = sum(wave) / period
    values = {k: [10 * k + 0.5 * i + wave[i % period] for i in range(90)] for k in (1, 2)}
    rows = [(k, START + timedelta(hours=i), v if i % 31 else None) for k, vs in values.items() for i, v in enumerate(vs)]
    grid = spark.createDataFrame(rows, "meter_id long, bucket timestamp_ntz, load double")
    found = m.decompose(grid, "load", period, block_rows=block_rows)
    half = period // 2
    away = {}
    for r in found.collect():
        i = int((r.bucket - START).total_seconds() / 3600)
        away.setdefault((r.meter_id, i), r)
        assert (r.load_trend is not None) == (half <= i <= 90 - half - 2)
        if r.load is not None and r.load_trend is not None:
            assert r.load_trend + r.load_season + r.load_rest == pytest.approx(r.load, abs=1e-9)
    assert len(away) == 180
    for i in range(40, 50):
        assert away[1, i].load_season == pytest.approx(wave[i % period] - mean, abs=0.6)
    with pytest.raises(ValueError):
        m.decompose(grid, "load", 12, "month")


def test_sketches(spark):
    draw = random.Random(9)
    rows = [(i, draw.randrange(400), START + timedelta(hours=draw.randrange(240)), draw.choice([None, float("nan"), draw.expovariate(1)])) for i in range(6000)]
    df = spark.createDataFrame(rows, "event_id long, meter_id long, ts timestamp_ntz, power_kw double")
    table = m.sketch_table(df)
    assert table.count() == 10
    told = m.sketched(m.merge_sketches(table), (0.1, 0.5, 0.9)).first()
    known = sorted(v for *_, v in rows if v is not None and v == v)
    assert (told.n, told.low, told.high) == (len(known), known[0], known[-1])
    for q, value in ((0.1, told.q10), (0.5, told.q50), (0.9, told.q90)):
        assert abs(sum(v <= value for v in known) / len(known) - q) <= 0.02
    assert abs(told.distinct_ids - 400) <= 12
    # Merged in two steps the estimate may change within its error, counts do not.
    parts = m.merge_sketches(table.withColumn("half", F.dayofmonth("date") % 2), ["half"])
    again = m.sketched(m.merge_sketches(parts), (0.5,)).first()
    assert again.n == told.n and abs(again.distinct_ids - 400) <= 12
    empty = m.sketched(m.sketch_table(df.where("power_kw is null"))).collect()
    assert all(r.n == 0 and r.q50 is None for r in empty)
    assert m.sketch_table(df.limit(0)).count() == 0


def test_search_learns_from_the_past_only(spark):
    df = readings_signal(spark, "/root/testdata/sf0.01").where("meter_id < 60")
    df = m.calendar_features(df, parts=("hour", "weekday")).withColumn("label", F.col("target"))
    training, _ = m.split_by_time(df, CUTOFF)
    candidates = [{"maxIter": 1, "maxDepth": 1}, {"maxIter": 15, "maxDepth": 4}]
    model, told = m.search(training, ["hour", "weekday"], candidates, "2024-01-18 00:00:00")
    assert told[0]["params"] == candidates[1] and told[0]["rmse"] < told[1]["rmse"]
    assert model.stages[-1].getNumTrees == told[0]["trees"] <= 15
    with pytest.raises(ValueError, match="candidates"):
        m.search(training, ["hour"], [], CUTOFF)
    with pytest.raises(ValueError, match="empty"):
        m.search(training, ["hour"], candidates, CUTOFF)


def files(path):
    return {os.path.basename(os.path.dirname(f)): os.path.basename(f) for f in glob.glob(f"{path}/date=*/*.parquet")}


def test_merge_touches_only_the_dates_of_new_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "event_id long, meter_id long, ts timestamp_ntz, power_kw double, version int"
    old = [(i, 1, START + timedelta(days=i % 3, minutes=i), float(i), 1) for i in range(9)]
    m.write_table(spark.createDataFrame(old, schema), path)
    before = files(path)
    day = START + timedelta(days=1)
    new = [
        (1, 1, day, 100.0, 2), (1, 1, day, 200.0, 3), (4, 1, day, -1.0, 0), (50, 2, day, 5.0, 1),
        (60, 2, START + timedelta(days=9), 6.0, 1), (60, 2, START + timedelta(days=9), 6.0, 1),
    ]
    touched = m.merge_readings(spark, path, spark.createDataFrame(new, schema), version=["version"])
    assert sorted(str(r.date) for r in touched.collect()) == ["2024-01-02", "2024-01-10"]
    found = {r.event_id: r.power_kw for r in spark.read.parquet(path).collect()}
    expected = {i: v for i, _, _, v, _ in old} | {1: 200.0, 50: 5.0, 60: 6.0}
    assert found == expected  # the older version of 4 does not replace it
    assert spark.read.parquet(path).count() == len(expected)
    after = files(path)
    assert {d: f for d, f in after.items() if d in ("date=2024-01-01", "date=2024-01-03")} == {
        d: f for d, f in before.items() if d != "date=2024-01-02"
    }
    assert m.merge_readings(spark, path, spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError, match="ts"):
        m.merge_readings(spark, path, spark.createDataFrame([(1, 1, None, 1.0, 1)], schema))


def test_refresh_leaves_other_meters_alone(spark, tmp_path):
    table, features = str(tmp_path / "t"), str(tmp_path / "f")
    schema = "event_id long, meter_id long, ts timestamp_ntz, power_kw double"
    rows = [(i, i % 2, START + timedelta(hours=6 * i), float(i)) for i in range(20)]
    make = lambda df: m.lag_features(df, lags=(1, 3), order=("ts", "event_id"))
    m.write_table(spark.createDataFrame(rows, schema), table)
    m.write_table(make(spark.read.parquet(table).drop("date")), features)
    before = files(features)
    late = [(100, 1, START + timedelta(days=3, hours=1), 55.0)]
    new = spark.createDataFrame(late, schema)
    m.merge_readings(spark, table, new)
    m.refresh_features(spark, spark.read.parquet(table).drop("date"), features, new, make, reach=3)
    names = ["event_id", "power_kw_lag_1", "power_kw_lag_3"]
    found = {tuple(r) for r in spark.read.parquet(features).select(*names).collect()}
    whole = make(spark.read.parquet(table).drop("date")).select(*names)
    assert found == {tuple(r) for r in whole.collect()} and len(found) == 21
    after = files(features)
    assert all(after[d] == f for d, f in before.items() if d < "date=2024-01-04")
