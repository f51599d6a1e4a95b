"""Sources, sinks, SQL and plain selections."""

from __future__ import annotations

from pyspark.sql import functions as F

import meterlab as m
from meterlab.catalog.fixtures import (
    READINGS,
    READINGS_RAW,
    readings,
    readings_null,
    readings_raw,
)
from meterlab.catalog.registry import exact_mean, exact_sum, long_ints, registered
from meterlab.plans.blocks import scratch_path


@registered(f"WITH {READINGS} SELECT * FROM readings")
def read_readings(spark, folder):
    return readings(spark, folder)


@registered(
    f"""WITH {READINGS_RAW}
    SELECT CAST(event_id AS VARCHAR) AS event_id, power_text, ts_text FROM readings"""
)
def read_raw_text(spark, folder):
    path = scratch_path(spark, "raw-text")
    readings_raw(spark, folder).write.csv(path, sep=";", header=True)
    return m.read_raw_text(spark, path, ["event_id", "power_text", "ts_text"], sep=";")


@registered(f"WITH {READINGS} SELECT * FROM readings")
def write_table(spark, folder):
    path = scratch_path(spark, "readings")
    m.write_table(readings(spark, folder), path, sort_by=["meter_id", "ts"])
    return m.read_readings(spark, path)


@registered(
    f"""WITH {READINGS}
    SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n_readings,
           {exact_sum("power_kw")} AS total
    FROM readings WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1"""
)
def read_one_date(spark, folder):
    """One partition of a table written by date; the others are not read."""
    path = scratch_path(spark, "readings-by-date")
    m.write_table(readings(spark, folder), path)
    day = spark.read.parquet(path).where(F.col("date") == F.lit("2024-01-15").cast("date"))
    hours = m.load_profile(day, scale=2)
    totals = m.trend(day, "hour", scale=2).select(F.hour("bucket").alias("hour"), "total")
    return long_ints(hours.join(totals, "hour").select("hour", "n_readings", "total"))


@registered(
    f"""WITH {READINGS}
    SELECT channel, count(*) AS n_readings, max(power_kw) AS max_kw
    FROM readings GROUP BY channel"""
)
def register_for_sql(spark, folder):
    m.register(readings(spark, folder), "meter_readings")
    return spark.table("meter_readings").groupBy("channel").agg(
        F.count("*").alias("n_readings"), F.max("power_kw").alias("max_kw")
    )


@registered(
    f"""WITH {READINGS}
    SELECT channel, CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n_readings,
           {exact_mean("power_kw")} AS mean_kw
    FROM readings WHERE power_kw > 10 GROUP BY 1, 2"""
)
def sql_query(spark, folder):
    m.register(readings(spark, folder), "meter_readings")
    return m.query(
        spark,
        """SELECT channel, CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n_readings,
                  CAST(sum(CAST(power_kw AS DECIMAL(18,2))) AS DOUBLE) / count(power_kw) AS mean_kw
           FROM meter_readings WHERE power_kw > :least GROUP BY 1, 2""",
        least=10,
    )


@registered(
    f"""WITH {READINGS}
    SELECT meter_id, count(*) AS n_readings, max(power_kw) AS max_kw,
           {exact_sum("power_kw")} AS total
    FROM readings WHERE channel <> 'error' GROUP BY meter_id
    ORDER BY total DESC, meter_id LIMIT 20"""
)
def dataframe_query(spark, folder):
    """The 20 meters with the largest totals."""
    return (
        readings(spark, folder)
        .where(F.col("channel") != "error")
        .groupBy("meter_id")
        .agg(
            F.count("*").alias("n_readings"),
            F.max("power_kw").alias("max_kw"),
            F.sum(F.col("power_kw").cast("decimal(18,2)")).cast("double").alias("total"),
        )
        .orderBy(F.desc("total"), "meter_id")
        .limit(20)
    )


@registered(
    f"""WITH {READINGS} SELECT * FROM readings
    WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:30:00'"""
)
def between(spark, folder):
    return m.between(readings(spark, folder), "2024-01-10 06:00:00", "2024-01-12 18:30:00")


_PEAKS = """WITH {0}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY {1} ORDER BY power_kw DESC, event_id) AS rank
      FROM readings)
    SELECT event_id, meter_id, ts, power_kw, channel, rank FROM ranked WHERE rank <= {2}"""


@registered(_PEAKS.format(READINGS, "CAST(ts AS DATE)", 3))
def peaks_per_day(spark, folder):
    return long_ints(m.peaks(readings(spark, folder), k=3).drop("date"))


@registered(_PEAKS.format(READINGS, "meter_id", 5))
def peaks_per_meter(spark, folder):
    return long_ints(m.peaks(readings(spark, folder), by=["meter_id"], k=5))


@registered(
    """WITH readings AS (
      SELECT event_id, user_id AS meter_id, ts, value AS power_kw, event_type AS channel
      FROM events WHERE event_id % 7 <> 0 AND event_id % 3 <> 0), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY power_kw DESC, event_id)
        AS rank FROM readings)
    SELECT event_id, meter_id, ts, power_kw, channel, rank FROM ranked WHERE rank <= 3"""
)
def peaks_with_missing(spark, folder):
    """Neither NULL nor NaN is a peak."""
    not_a_number = F.when(F.col("event_id") % 3 == 0, float("nan")).otherwise(F.col("power_kw"))
    df = readings_null(spark, folder).withColumn("power_kw", not_a_number)
    return long_ints(m.peaks(df, k=3).drop("date"))
