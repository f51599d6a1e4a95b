"""As-of joins, weighted means, runs of readings, and totals without the current row."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tiny import table

import meterlab as m
from meterlab.plans import blocks

START = datetime(2024, 1, 1)


def stamps(draw, count, meters=3):
    """Rows (event_id, meter, time, value) with ties, NULL keys, NULL times, and NULL and NaN values."""
    rows = []
    for i in range(count):
        at = None if draw.random() < 0.03 else START + timedelta(minutes=draw.randrange(count))
        value = draw.choice([None, float("nan"), *[round(draw.uniform(-5, 50), 2) for _ in range(6)]])
        rows.append((i, draw.choice([None, *range(meters)]), at, value))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "event_id long, meter_id long, ts timestamp_ntz, power_kw double")


def brute_asof(rows, others, direction, exact, tolerance):
    out = {}
    for i, meter, at, _ in rows:
        best = None
        for j, other_meter, other_at, _ in others:
            if meter != other_meter or at is None or other_at is None:
                continue
            away = (at - other_at if direction == "backward" else other_at - at).total_seconds()
            if away < 0 or (away == 0 and not exact) or (tolerance and away > tolerance * 60):
                continue
            if best is None or (away, -j) < best[0]:
                best = ((away, -j), j)
        out[i] = best[1] if best else None
    return out


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize(("exact", "tolerance", "block_rows"), [(True, None, 10**6), (False, 7, 10**6), (True, 4, 20), (False, None, 20)])
def test_asof_join(spark, direction, exact, tolerance, block_rows):
    draw = random.Random(f"{direction}{exact}{tolerance}")
    rows, others = stamps(draw, 150), stamps(draw, 90)
    joined = m.asof_join(
        frame(spark, rows), frame(spark, others), cols=["event_id"], order=["event_id"], direction=direction, exact=exact,
        tolerance=tolerance and f"{tolerance} minutes", block_rows=block_rows,
    )
    found = {r.event_id: r.event_id_asof for r in joined.collect()}
    assert joined.columns == ["event_id", "meter_id", "ts", "power_kw", "ts_asof", "event_id_asof"]
    assert found == brute_asof(rows, others, direction, exact, tolerance)


def test_asof_join_without_keys_and_edges(spark):
    rows = [(1, 5, START, 1.0), (2, 6, START + timedelta(hours=2), 2.0)]
    prices = spark.createDataFrame([(START - timedelta(days=1), 0.3), (START + timedelta(hours=1), 0.4)], "ts timestamp_ntz, price double")
    joined = m.asof_join(frame(spark, rows), prices, by=())
    assert {r.event_id: r.price_asof for r in joined.collect()} == {1: 0.3, 2: 0.4}
    assert m.asof_join(frame(spark, []), prices, by=()).count() == 0
    alone = m.asof_join(frame(spark, rows), prices.limit(0), by=())
    assert [r.price_asof for r in alone.collect()] == [None, None]
    with pytest.raises(ValueError, match="direction"):
        m.asof_join(prices, prices, by=(), direction="nearest")
    with pytest.raises(ValueError, match="exist already"):
        m.asof_join(prices, prices, by=(), suffix="")


def test_asof_join_is_one_shuffle_of_both(spark):
    rows = frame(spark, stamps(random.Random(1), 50))
    plan = m.asof_join(rows, rows, split="never")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def brute_ewm(rows, half_life, by_rows):
    keys = sorted({r[1] for r in rows}, key=str)
    out = {r[0]: None for r in rows}
    for key in keys:
        series = sorted((r for r in rows if r[1] == key and r[2] is not None), key=lambda r: (r[2], r[0]))
        seen = []
        for i, _, at, value in series:
            if seen:
                last = len(seen) if by_rows else seen[-1][0]
                weights = [2.0 ** (-((last - (n + 1)) if by_rows else (last - t).total_seconds()) / half_life) for n, (t, _) in enumerate(seen)]
                out[i] = sum(w * v for w, (_, v) in zip(weights, seen, strict=True)) / sum(weights)
            if value is not None and value == value:
                seen.append((at, value))
    return out


@pytest.mark.parametrize("block_rows", [10**6, 15])
@pytest.mark.parametrize("half_life", ["1 second", "5 minutes", "3 days", 1, 4, 1000])
def test_ewm(spark, half_life, block_rows):
    rows = stamps(random.Random(7), 200, meters=2)
    df = m.ewm_features(frame(spark, rows), half_life=half_life, order=("ts", "event_id"), out="mean", block_rows=block_rows)
    found = {r.event_id: r["mean"] for r in df.collect()}
    length = {"1 second": 1, "5 minutes": 300, "3 days": 3 * 86400}.get(half_life, half_life)
    expected = brute_ewm(rows, length, isinstance(half_life, int))
    assert found.keys() == expected.keys()
    for i, value in expected.items():
        assert (found[i] is None) == (value is None), i
        assert value is None or found[i] == pytest.approx(value, rel=1e-9, abs=1e-9), i


def test_ewm_after_a_long_gap(spark):
    """A thousand half-lives later the mean is still that of the last readings, not 0 / 0."""
    times = [0, 1, 2, 399, 400, 401, 2000, 2001]
    rows = [(i, 1, START + timedelta(seconds=t), float(i + 1)) for i, t in enumerate(times)]
    df = m.ewm_features(frame(spark, rows), half_life="1 second", out="mean")
    found = {r.event_id: r["mean"] for r in df.collect()}
    assert {i: pytest.approx(v) for i, v in brute_ewm(rows, 1, False).items() if v} == {i: v for i, v in found.items() if v}
    assert found[0] is None and m.ewm_features(df.drop("mean").limit(0)).count() == 0
    with pytest.raises(ValueError):
        m.ewm_features(df, half_life=0)


@pytest.mark.parametrize("block_rows", [10**6, 25])
def test_sessions_and_outages(spark, block_rows):
    rows = stamps(random.Random(11), 220)
    df, limit = frame(spark, rows), timedelta(minutes=2)
    expected, gaps = [], []
    for meter in {r[1] for r in rows}:
        times = sorted(r[2] for r in rows if r[1] == meter and r[2] and r[3] is not None and r[3] == r[3])
        runs = []
        for at in times:
            if runs and at - runs[-1][-1] <= limit:
                runs[-1].append(at)
            else:
                if runs:
                    gaps.append((meter, runs[-1][-1], at, int((at - runs[-1][-1]).total_seconds())))
                runs.append([at])
        expected += [(meter, n, run[0], run[-1], len(run)) for n, run in enumerate(runs)]
    found = [tuple(r) for r in m.sessions(df, "2 minutes", block_rows=block_rows).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    found = [tuple(r) for r in m.outages(df, "2 minutes", block_rows=block_rows).collect()]
    assert sorted(found, key=str) == sorted(gaps, key=str)
    assert m.sessions(df.limit(0)).count() == 0 and m.outages(df.where("ts is null")).count() == 0


@pytest.mark.parametrize("block_rows", [10**6, 10])
def test_totals_before_the_row(spark, block_rows):
    df = frame(spark, [(i, i % 2, START + timedelta(hours=i), 1.0 + i) for i in range(60)]).withColumn("one", F.lit(1))
    found = blocks.running_totals(df, ["meter_id"], ["ts"], {"n": "one", "s": "power_kw"}, before=True, block_rows=block_rows)
    for r in found.collect():
        earlier = [1.0 + i for i in range(r.event_id) if i % 2 == r.meter_id]
        assert (r.n or 0, r.s or 0.0) == (len(earlier), sum(earlier))


def test_settled_deletes_what_led_to_it(spark):
    made = []

    def build():
        made.append(blocks.settle(spark.range(10), "first"))
        made.append(blocks.settled(lambda: blocks.settle(made[0].where("id > 3"), "inner").where("id < 8"), "second"))
        return made[1].selectExpr("id * 2 AS id")

    stored = blocks.settled(build, "last")
    assert sorted(r.id for r in stored.collect()) == [8, 10, 12, 14]
    for gone in made:
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
            spark.read.parquet(gone.inputFiles()[0]).collect()


def test_nan_is_missing(spark):
    nan = float("nan")
    df = table(spark, [(1, f"2024-01-01 0{h}:00:00", v) for h, v in enumerate([nan, 2.0, 4.0, 1.0])])
    row = m.rolling_rows(df, n=3, stats=("mean", "max", "count", "std")).orderBy("ts").collect()[3]
    assert (row.power_kw_roll_3_mean, row.power_kw_roll_3_max, row.power_kw_roll_3_count) == (3.0, 4.0, 2)
    row = m.rolling_time(df, width="1 day", stats=("mean", "max", "count")).orderBy("ts").collect()[3]
    assert (row.power_kw_1_day_mean, row.power_kw_1_day_max, row.power_kw_1_day_count) == (3.0, 4.0, 2)
    pairs = m.correlations(df.withColumn("hour", F.hour("ts").cast("double")), pairs=[("power_kw", "hour")]).first()
    assert pairs.n == 3 and pairs["corr"] == pytest.approx(-0.327326835)


def test_times_are_looked_back_at_once(spark):
    df = frame(spark, stamps(random.Random(2), 30))
    plan = m.delta_features(df, split="never")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lag(ts") == 1


def test_rows_without_a_time_are_dealt(spark):
    rows = [(i, 1, None if i % 2 else START + timedelta(days=i // 2), float(i)) for i in range(40)]
    df = m.seasonal_lag(frame(spark, rows), period="1 day", unique=True)
    found = {r.event_id: r.power_kw_1_day_ago for r in df.collect()}
    assert found == {i: None if i % 2 or i == 0 else float(i - 2) for i in range(40)}


@pytest.mark.parametrize("block_rows", [10, 40, 10**6])
def test_lags_beyond_a_block(spark, block_rows):
    rows = [(i, i % 2 or None, START + timedelta(minutes=i), None if i % 9 == 0 else float(i)) for i in range(120)]
    df = m.history_features(frame(spark, rows), lags=(30, 1), rolling=(2, 300), stats=("count",), delta=True, block_rows=block_rows)
    assert df.columns[4:] == [
        "power_kw_lag_30", "power_kw_lag_1", "power_kw_roll_2_count", "power_kw_roll_300_count", "power_kw_delta", "seconds_since_previous",
    ]
    value = {i: v for i, _, _, v in rows}
    for r in df.collect():
        far, near = r.event_id - 60, r.event_id - 2
        assert (r.power_kw_lag_30, r.power_kw_lag_1) == (value.get(far), value.get(near))
        assert r.power_kw_roll_300_count == sum(value[i] is not None for i in range(r.event_id % 2, r.event_id, 2))
