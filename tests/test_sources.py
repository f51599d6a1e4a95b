import glob

import pytest
from pyspark.sql import functions as F
from tiny import same_rows, table

import meterlab as m
from meterlab.catalog.fixtures import EVENT_NAMES, readings

ROWS = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 23:59:59.999999", None), (2, "2024-01-02 00:00:00", 3.0)]


def test_round_trip_is_lossless_and_partitioned(spark, tmp_path):
    df = table(spark, ROWS).withColumn("channel", F.lit("a"))
    path = str(tmp_path / "t")
    assert m.write_table(df, path, sort_by=["meter_id", "ts"]) is df
    assert {p.rsplit("=", 1)[1] for p in glob.glob(f"{path}/date=*")} == {"2024-01-01", "2024-01-02"}
    same_rows(m.read_readings(spark, path), df)
    with pytest.raises(Exception, match="exist"):
        m.write_table(df, path)
    m.write_table(df, path, mode="overwrite")


def test_table_without_partitions(spark, tmp_path):
    df = table(spark, ROWS).withColumn("channel", F.lit("a"))
    m.write_table(df, str(tmp_path / "t"), partition_by=())
    same_rows(m.read_readings(spark, str(tmp_path / "t")), df)


def test_other_formats_and_names(spark, tmp_path):
    df = table(spark, ROWS).withColumn("channel", F.lit("a"))
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    for fmt, options in (("orc", {}), ("json", micros)):
        path = str(tmp_path / fmt)
        df.withColumnRenamed("meter_id", "user_id").write.format(fmt).options(**options).save(path)
        back = m.read_readings(spark, path, fmt, rename={"user_id": "meter_id"}, **options)
        same_rows(back, df)


def test_raw_text_is_all_strings_and_short_lines_get_nulls(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Date;Power\n16/12/2006;4.216\n17/12/2006;?\n18/12/2006\n")
    df = m.read_raw_text(spark, str(tmp_path), ["Date", "Power"], sep=";")
    assert df.dtypes == [("Date", "string"), ("Power", "string")]
    assert sorted(df.collect()) == [("16/12/2006", "4.216"), ("17/12/2006", "?"), ("18/12/2006", None)]
    assert m.read_raw_text(spark, str(tmp_path), ["a", "b"], sep=";", header=False).count() == 4


def test_register_and_query_with_arguments(spark):
    m.register(table(spark, ROWS), "tiny")
    assert m.query(spark, "SELECT count(*) AS n FROM tiny WHERE power_kw > :x", x=2).first().n == 1
    assert m.query(spark, "SELECT count(*) AS n FROM tiny").first().n == 3


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def events(spark, tables):
    return readings(spark, tables)


def test_filters_and_columns_reach_the_scan(spark, tables, events):
    text = plan(m.between(events, "2024-01-10", "2024-01-11").select("meter_id", "ts"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00), LessThan(ts,2024-01-11T00:00)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text or "ReadSchema: struct<user_id:bigint,ts:timestamp_ntz>" in text
    path = f"{tables}/events.parquet"
    bare = m.read_readings(spark, path, rename=EVENT_NAMES, nan_as_null=False)
    assert "GreaterThan(value,10.0)" in plan(bare.where("power_kw > 10"))


def test_dates_prune_partitions(spark, events, tmp_path):
    m.write_table(events, str(tmp_path / "t"))
    day = spark.read.parquet(str(tmp_path / "t")).where("date = DATE'2024-01-15'")
    assert "PartitionFilters: [isnotnull(date" in plan(day)
    assert len(day.inputFiles()) == 1 or day.rdd.getNumPartitions() <= 2


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


def test_history_needs_one_shuffle_and_one_sort(events):
    df = m.history_features(events, lags=(1, 24), rolling=(3, 24), delta=True, order=["ts", "event_id"])
    text = physical(df)
    assert text.count("Exchange") == 1 and text.count("+- Sort") == 1


def test_rolling_time_needs_one_shuffle(events):
    assert physical(m.rolling_time(events)).count("Exchange") == 1


def test_peaks_limit_before_the_shuffle(events):
    text = physical(m.peaks(events))
    assert text.count("Exchange") == 2 and text.count("Partial") == 2


def test_few_means_need_no_shuffle_of_readings(events):
    text = physical(m.fill_mean(events))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_grid_joins_nothing(events):
    assert "Join" not in physical(m.regular_grid(events))


def test_a_grid_and_its_earlier_values_need_one_more_shuffle(events):
    grid = m.regular_grid(events, aggs=("max",))
    both = m.seasonal_lag(grid, "power_kw_max", ts="bucket", unique=True)
    assert physical(both).count("Exchange") == physical(grid).count("Exchange") + 1
    assert "Join" not in physical(both)


def test_trend_aggregates_before_its_shuffle(events):
    text = physical(m.trend(events))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_no_python_in_any_plan(spark, events):
    for df in (m.rolling_time(events), m.summarise(events), m.peaks(events), m.regular_grid(events)):
        assert "Python" not in physical(df)
        assert "CartesianProduct" not in physical(df) and "NestedLoop" not in physical(df)


def test_a_large_date_is_written_by_several_tasks(spark, tmp_path):
    """One date with nearly all rows does not end in one task."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 100 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("timestamp_ntz").alias("ts"),
        F.xxhash64("id").alias("meter_id"),
    )
    wide = df.repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        m.write_table(wide, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(str(tmp_path / "t" / "date=2024-01-01" / "*.parquet"))) > 2
    assert len(glob.glob(str(tmp_path / "t" / "date=2024-01-02" / "*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000
