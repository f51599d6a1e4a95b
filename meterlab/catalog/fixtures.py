"""Readings made of the given tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from meterlab import read_readings

EVENT_NAMES = {"user_id": "meter_id", "value": "power_kw", "event_type": "channel"}
ORDER = ("ts", "event_id")
CUTOFF = "2024-01-25 00:00:00"

_ORDERS_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("meter_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("power_kw", DoubleType()),
        StructField("channel", StringType()),
    ]
)
_ORDER_NAMES = {
    "o_orderkey": "event_id",
    "o_custkey": "meter_id",
    "o_orderdate": "ts",
    "o_totalprice": "power_kw",
    "o_orderpriority": "channel",
}


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return read_readings(spark, f"{folder}/events.parquet", rename=EVENT_NAMES)


def readings_null(spark: SparkSession, folder: str) -> DataFrame:
    missing = F.col("event_id") % 7 == 0
    return readings(spark, folder).withColumn("power_kw", F.when(~missing, F.col("power_kw")))


def readings_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as text, some of it bad."""
    key = F.col("event_id")
    return readings(spark, folder).select(
        "event_id",
        F.when(key % 17 == 0, "?").otherwise(F.col("power_kw").cast("string")).alias("power_text"),
        F.when(key % 23 == 0, "bad")
        .otherwise(F.date_format("ts", "d/M/yyyy HH:mm:ss"))
        .alias("ts_text"),
    )


def one_meter(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).withColumn("meter_id", F.lit(0).cast("bigint"))


def one_meter_null(spark: SparkSession, folder: str) -> DataFrame:
    """One meter in which three readings out of four are missing, and days at a time."""
    key = F.col("event_id")
    gap = (key % 4 != 0) | F.dayofmonth("ts").isin(5, 6, 7, 20)
    return one_meter(spark, folder).withColumn("power_kw", F.when(~gap, F.col("power_kw")))


def readings_signal(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with a label that follows the hour and the weekday."""
    daily = F.lit(0.8) * F.sin(F.lit(2.0) * F.pi() * F.hour("ts") / F.lit(24.0))
    weekend = F.when(F.weekday("ts") >= 5, 0.5).otherwise(0.0)
    noise = F.lit(0.01) * (F.col("event_id") % 7)
    label = F.round(F.lit(1.0) + daily + weekend + noise, 6)
    return readings(spark, folder).withColumn("target", label)


def daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as readings over several years."""
    return read_readings(
        spark, f"{folder}/orders.parquet", schema=_ORDERS_SCHEMA, rename=_ORDER_NAMES
    )


# The same tables for the SQL twins, to be named in a WITH clause.
READINGS = """readings AS (
  SELECT event_id, user_id AS meter_id, ts, value AS power_kw, event_type AS channel FROM events)"""
READINGS_NULL = """readings AS (
  SELECT event_id, user_id AS meter_id, ts,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS power_kw, event_type AS channel
  FROM events)"""
READINGS_RAW = """readings AS (
  SELECT event_id,
         CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(value AS VARCHAR) END AS power_text,
         CASE WHEN event_id % 23 = 0 THEN 'bad'
              ELSE strftime(ts, '%-d/%-m/%Y %H:%M:%S') END AS ts_text
  FROM events)"""
ONE_METER = """readings AS (
  SELECT event_id, 0::BIGINT AS meter_id, ts, value AS power_kw, event_type AS channel
  FROM events)"""
ONE_METER_NULL = """readings AS (
  SELECT event_id, 0::BIGINT AS meter_id, ts,
         CASE WHEN event_id % 4 <> 0 OR day(ts) IN (5, 6, 7, 20) THEN NULL ELSE value END
           AS power_kw, event_type AS channel
  FROM events)"""
READINGS_SIGNAL = """readings AS (
  SELECT event_id, user_id AS meter_id, ts, value AS power_kw, event_type AS channel,
         round(1.0::DOUBLE + 0.8::DOUBLE * sin(2.0::DOUBLE * pi() * hour(ts) / 24.0::DOUBLE)
               + CASE WHEN isodow(ts) >= 6 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END
               + 0.01::DOUBLE * (event_id % 7), 6) AS target
  FROM events)"""
DAILY_ORDERS = """readings AS (
  SELECT o_orderkey AS event_id, o_custkey AS meter_id, o_orderdate AS ts,
         o_totalprice AS power_kw, o_orderpriority AS channel
  FROM orders)"""
