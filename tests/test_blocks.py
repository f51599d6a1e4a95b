"""Long series worked on in blocks give what one window gives."""

import random

import pytest
from pyspark.sql import functions as F
from tiny import same_rows, table

import meterlab as m
from meterlab.plans import blocks

ORDER = ["ts", "event_id"]


def readings(spark, seed, n=300):
    """One meter with most rows, the NULL meter with many, others with few; gaps and ties."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        meter = rng.choices([1, None, 2, 3, 4], [60, 25, 5, 5, 5])[0]
        second = rng.randrange(40) * 3_600
        value = None if rng.random() < 0.7 else round(rng.gauss(5, 2), 2)
        rows.append((meter, second, value))
    data = [(i, meter, s, v) for i, (meter, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id bigint, meter_id bigint, s bigint, power_kw double")
    return df.withColumn(
        "ts", F.timestamp_add("SECOND", F.col("s"), F.expr("timestamp_ntz'2024-01-01'"))
    ).drop("s")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("by", [("meter_id",), ()])
def test_history_and_forward_fill(spark, seed, by):
    df = readings(spark, seed).persist()
    settings = {"lags": (1, 7), "rolling": (3, 40), "delta": True, "by": by, "order": ORDER}
    same_rows(
        m.history_features(df, **settings, block_rows=25),
        m.history_features(df, **settings, split="never"),
    )
    same_rows(
        m.fill_forward(df, by=by, order=ORDER, block_rows=10),
        m.fill_forward(df, by=by, order=ORDER, split="never"),
    )
    df.unpersist()


@pytest.mark.parametrize("seed", [3, 4])
def test_rolling_time_equals_the_plain_range_frame(spark, seed):
    df = readings(spark, seed).persist()
    m.register(df, "uneven")
    plain = spark.sql(
        """SELECT *, count(power_kw) OVER w AS power_kw_5_hours_count,
             sum(power_kw) OVER w AS power_kw_5_hours_sum, avg(power_kw) OVER w AS power_kw_5_hours_mean,
             stddev_samp(power_kw) OVER w AS power_kw_5_hours_std,
             min(power_kw) OVER w AS power_kw_5_hours_min, max(power_kw) OVER w AS power_kw_5_hours_max
           FROM uneven WINDOW w AS (PARTITION BY meter_id ORDER BY ts
             RANGE BETWEEN INTERVAL '0 05:00:00' DAY TO SECOND PRECEDING
             AND INTERVAL '0 00:00:00.000001' DAY TO SECOND PRECEDING)"""
    )
    for block_rows in (8, 1_000_000):
        same_rows(m.rolling_time(df, width="5 hours", block_rows=block_rows), plain)
    df.unpersist()


def test_long_gaps_and_short_pieces(spark):
    """Nothing known for many blocks, then a reach over several of them."""
    rows = [(1, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", 1.0 * i if i in (0, 1, 170) else None) for i in range(200)]
    df = table(spark, rows)
    same_rows(
        m.fill_forward(df, order=ORDER, block_rows=5), m.fill_forward(df, order=ORDER, split="never")
    )
    same_rows(
        m.lag_features(df, lags=(1, 60), order=ORDER, block_rows=5),
        m.lag_features(df, lags=(1, 60), order=ORDER, split="never"),
    )


def test_copies_of_one_row_are_spread_over_blocks(spark):
    df = table(spark, [(1, "2024-01-01 00:00:00", 1.0)] * 400 + [(1, "2024-01-02 00:00:00", 2.0)])
    hot = blocks.split_hot(df.drop("event_id"), ["meter_id"], 20)[1]
    laid = blocks.lay_out(hot.df, hot.rows, ["meter_id"], ["ts"], 20)
    sizes = [r["count"] for r in laid.groupBy(blocks.BLOCK).count().collect()]
    assert sum(sizes) == 401 and max(sizes) <= 80
    lagged = m.lag_features(df.drop("event_id"), block_rows=20)
    assert lagged.count() == 401
    assert [r.power_kw_lag_1 for r in lagged.where("power_kw = 2").collect()] == [1.0]
    assert lagged.where("power_kw_lag_1 IS NULL").count() == 1


def test_many_blocks_take_few_tasks(spark):
    """Files, one per task, are as many as shuffle partitions; blocks are as many as asked, and ascend."""
    df = spark.range(3_000).select((F.col("id") * 7_919 % 3_000).alias("at"), F.col("id").alias("event_id"))
    laid = blocks.lay_out(df, 3_000, [], ["at"], 10)
    assert len(laid.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = laid.groupBy(blocks.BLOCK).agg(F.count("*").alias("n"), F.min("at"), F.max("at")).orderBy(blocks.BLOCK).collect()
    assert len(found) >= 300 and max(r.n for r in found) <= 10 and sum(r.n for r in found) == 3_000
    ends = [x for r in found for x in r[2:]]
    assert ends == sorted(ends)


def test_split_parts_the_keys_and_counts_them(spark):
    df = readings(spark, 5)
    light, hot = blocks.split_hot(df, ["meter_id"], 40)
    assert hot.keys == 2 and hot.rows == hot.df.count()
    assert {r.meter_id for r in hot.df.select("meter_id").distinct().collect()} == {1, None}
    assert light.count() + hot.rows == df.count()
    assert blocks.split_hot(df, ["meter_id"], 10_000)[1] is None


def test_more_hot_keys_than_may_be_broadcast(spark, monkeypatch):
    df = readings(spark, 6)
    expected = m.lag_features(df, order=ORDER, split="never")
    monkeypatch.setattr(blocks, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(blocks, "PIECES", 2)
    same_rows(m.lag_features(df, order=ORDER, block_rows=20), expected)


def test_empty_table(spark):
    df = table(spark, [])
    assert m.history_features(df, rolling=(3,), delta=True).count() == 0
    assert m.rolling_time(df).count() == 0
    assert m.fill_forward(df, by=()).count() == 0


def test_running_total_in_blocks(spark):
    df = readings(spark, 8).withColumn("one", F.lit(1).cast("bigint"))
    same_rows(
        blocks.running_total(df, ["meter_id"], ["event_id"], "one", "upto", block_rows=15),
        blocks.running_total(df, ["meter_id"], ["event_id"], "one", "upto", split="never"),
    )


def test_scratch_tables_go_to_the_checkpoint_folder(spark):
    folder = blocks.ensure_checkpoint_dir(spark)
    assert blocks.scratch_path(spark, "x").startswith(folder)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert named.rstrip("/") in folder


def test_hot_times_beyond_the_broadcast_bound(spark, monkeypatch):
    """A time with many copies is joined by broadcast, the other times by shuffle."""
    rows = [(1, "2024-01-01 10:00:00", 1.0 * i) for i in range(60)]
    rows += [(1, f"2024-01-01 {h:02d}:30:00", 2.0) for h in range(24)]
    df = table(spark, rows)
    expected = m.rolling_time(df, split="never")
    monkeypatch.setattr(blocks, "BROADCAST_ROWS", 5)
    same_rows(m.rolling_time(df, block_rows=20), expected)


def test_adaptive_execution_splits_a_hot_join_key(spark):
    """Rows at one time are split where values an hour earlier are joined by shuffle."""
    df = spark.range(40_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("meter_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, int(id % 2))").alias("ts"),
        F.col("id").cast("double").alias("power_kw"),
    )
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        joined = m.seasonal_lag(df.repartition(8), period="1 hour")
        rows = joined.collect()
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in small:
            spark.conf.unset(name)
    assert len(rows) == 40_000
    assert "SortMergeJoin(skew=true)" in text


@pytest.mark.parametrize("by", [("meter_id",), ()])
def test_many_trailing_rows_equal_the_sliding_frame(spark, monkeypatch, by):
    from meterlab.operators import features

    df = readings(spark, 9)
    settings = {"n": 30, "by": by, "order": ORDER}
    sliding = m.rolling_rows(df, **settings, split="never")
    monkeypatch.setattr(features, "SLIDING_ROWS", 29)
    same_rows(m.rolling_rows(df, **settings, split="never"), sliding)
    same_rows(m.rolling_rows(df, **settings, block_rows=20), sliding)


def test_few_and_many_rows_agree(spark, monkeypatch):
    """Both ways to build trailing rows: the same columns in the same order, the same values."""
    df = readings(spark, 9).persist()
    settings = {"lags": (1,), "rolling": (20, 3), "stats": m.operators.trailing.TIME_STATS, "order": ORDER}
    sliding = m.history_features(df, **settings)
    monkeypatch.setattr(m.operators.features, "SLIDING_ROWS", 5)
    built = m.history_features(df, **settings)
    assert built.columns == sliding.columns
    same_rows(built, sliding)
    df.unpersist()
