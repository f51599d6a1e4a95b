import random
import statistics

import pytest
from pyspark.sql import functions as F
from tiny import at, same_rows, table

import meterlab as m

ROWS = [
    (1, "2024-01-01 22:10:00", 1.0),
    (1, "2024-01-01 22:50:00", 3.0),
    (1, "2024-01-02 01:00:00", 5.0),
    (2, "2024-01-01 00:00:00", None),
    (2, "2024-01-31 00:00:00", -7.0),
]


def test_between_is_half_open(spark):
    df = m.between(table(spark, ROWS), "2024-01-01 22:10:00", "2024-01-02 01:00:00")
    assert [r.event_id for r in df.orderBy("event_id").collect()] == [0, 1]


def test_peaks_break_ties_by_key_and_skip_nulls(spark):
    rows = [(1, "2024-01-01 00:00:00", v) for v in (2.0, 5.0, None, 5.0, 1.0, 5.0)]
    for slices in (1, 3):
        df = m.peaks(table(spark, rows), k=2, slices=slices)
        assert sorted((r["rank"], r.event_id) for r in df.collect()) == [(1, 1), (2, 3)]
    df = m.peaks(table(spark, rows), by=["meter_id"], k=10)
    assert [r.event_id for r in df.orderBy("rank").collect()] == [1, 3, 5, 0, 4]


def test_peaks_beyond_the_pushed_limit_equal_a_sort(spark):
    values = [random.Random(1).randrange(50) / 10 for _ in range(3_000)]
    df = table(spark, [(1, "2024-01-01 00:00:00", v) for v in values])
    best = sorted(range(3_000), key=lambda i: (-values[i], i))[:1_500]
    got = m.peaks(df, k=1_500, slices=4).orderBy("rank")
    assert [r.event_id for r in got.collect()] == best


def test_trend_and_profile(spark):
    df = table(spark, ROWS)
    days = {r.bucket: (r.n_readings, r.total, r["mean"], r["max"]) for r in m.trend(df).collect()}
    assert days[at("2024-01-01 00:00:00")] == (3, 4.0, 2.0, 3.0)
    months = {r.bucket: r.total for r in m.trend(df, "month").collect()}
    assert months == {at("2024-01-01 00:00:00"): 2.0}
    profile = {r.hour: r["mean"] for r in m.load_profile(df).collect()}
    assert profile == {22: 2.0, 1: 5.0, 0: -7.0}
    wide = m.load_profile(df, ["hour"], wide=True).first()
    assert wide.n_readings == 5 and wide.h22 == 2.0 and wide.h5 is None


def test_histogram_bins_negative_and_missing_values(spark):
    rows = {r.bin: (r.bin_start, r.n) for r in m.histogram(table(spark, ROWS), width=2.0).collect()}
    assert rows == {0: (0.0, 1), 1: (2.0, 1), 2: (4.0, 1), -4: (-8.0, 1), None: (None, 1)}


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5), (2.0, 4.0, 5), (3.0, None, 5), (None, 1.0, 5)], "a double, b double, c int")
    got = {(r.a, r.b): (r.n, r["corr"]) for r in m.correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == (2, pytest.approx(1.0))
    assert got["a", "c"] == (3, None)
    assert m.correlations(df, pairs=[("b", "a")]).count() == 1


def test_share_sums_to_one(spark):
    df = table(spark, ROWS).withColumn("channel", F.col("event_id").cast("string"))
    shares = m.share(df.where("meter_id = 1"), period="month").collect()
    assert sum(r.share for r in shares) == pytest.approx(1.0)
    assert {r.channel: r.share for r in shares}["2"] == pytest.approx(5 / 9)


def test_plot_table_is_bounded_and_ordered(spark):
    rows = m.plot_table(table(spark, ROWS), [F.desc("power_kw")], 2).collect()
    assert [r.power_kw for r in rows] == [5.0, 3.0]


@pytest.mark.parametrize("by", [[], ["meter_id"]])
def test_exact_quantiles_in_blocks(spark, by):
    rng = random.Random(7)
    rows = [(rng.choice([1, 1, 1, 2, None]), "2024-01-01 00:00:00", rng.choice([None, float("nan"), rng.gauss(0, 1), 0.5])) for _ in range(900)]
    df = table(spark, rows)
    qs = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)
    known = df.where("power_kw IS NOT NULL AND NOT isnan(power_kw)")
    names = [f"q{q * 100:g}".replace(".", "_") for q in qs]
    plain = known.groupBy(*by).agg(*[F.percentile("power_kw", F.lit(q)).alias(n) for q, n in zip(qs, names, strict=True)])
    same_rows(m.exact_quantiles(df, "power_kw", by, qs, block_rows=50), plain)
    same_rows(m.exact_quantiles(df, "power_kw", by, qs), plain)
    values = [v for _, _, v in rows if v is not None and v == v]
    if not by:
        assert m.exact_quantiles(df, "power_kw", (), (0.5,), block_rows=50).first().q50 == pytest.approx(statistics.median(values))


def test_summarise_approximately(spark):
    row = m.summarise(table(spark, ROWS), exact=False).first()
    assert row.n == 4 and row["min"] == -7.0 and row.q50 in (1.0, 3.0)


def test_summarise_groups_without_spread(spark):
    rows = [(1, None, 2.0), (2, None, 3.0), (2, None, 3.0), (3, None, None)]
    got = {r.meter_id: r for r in m.summarise(table(spark, rows), by=["meter_id"]).collect()}
    assert (got[1].n, got[1].std, got[1].q50) == (1, None, 2.0)
    assert (got[2].std, got[2].skewness, got[2].kurtosis) == (0.0, None, None)
    assert (got[3].n, got[3]["mean"], got[3].q25) == (0, None, None)
    large = m.summarise(table(spark, rows), by=["meter_id"], block_rows=1)
    same_rows(large, m.summarise(table(spark, rows), by=["meter_id"]))
