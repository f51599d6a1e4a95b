"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)
from meterlab.functions import known

READINGS_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("meter_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("power_kw", DoubleType()),
        StructField("channel", StringType()),
    ]
)


def read_readings(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: StructType | None = None,
    rename: Mapping[str, str] | None = None,
    nan_as_null: bool = True,
    **options: Any,
) -> DataFrame:
    """Load readings with a declared schema; ``rename`` maps stored to own names.

    NaN counts as missing, so it becomes NULL here, once. Filters on floating
    point columns then stay above the scan; pass ``nan_as_null=False`` for data
    known to hold no NaN to have them pushed down too.
    """
    names = dict(rename or {})
    stored = {new: old for old, new in names.items()}
    declared = schema or READINGS_SCHEMA
    on_disk = StructType(
        [StructField(stored.get(f.name, f.name), f.dataType, f.nullable) for f in declared]
    )
    df = spark.read.format(fmt).options(**options).schema(on_disk).load(path)
    columns = []
    for field in on_disk:
        value = F.col(field.name)
        if nan_as_null:
            value = known(value, field.dataType)
        columns.append(value.alias(names.get(field.name, field.name)))
    return df.select(*columns)


def read_raw_text(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    sep: str = ",",
    header: bool = True,
    **options: Any,
) -> DataFrame:
    """Load delimited text with every column as STRING, nothing inferred.

    One record per line, so large files are split over tasks. Records with too
    few fields get NULLs.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    return spark.read.options(**options).csv(path, schema=schema, sep=sep, header=header)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date",),
    sort_by: Sequence[str] = (),
    mode: str = "errorifexists",
    ts: str = "ts",
) -> DataFrame:
    """Write Parquet partitioned by date, and return ``df`` for chaining.

    The REBALANCE hint gathers each partition value into few files and lets
    adaptive execution split a value that holds too many rows, so neither many
    small files nor one huge task comes out. ``sort_by`` orders rows inside the
    files, which tightens the min/max statistics that scans prune by.
    """
    out = df
    if "date" in partition_by and "date" not in df.columns:
        out = out.withColumn("date", F.to_date(ts))
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a DataFrame queryable by name in SQL."""
    df.createOrReplaceTempView(name)
    return df


def query(spark: SparkSession, sql: str, **args: Any) -> DataFrame:
    """Run any Spark SQL over registered tables; ``:name`` marks take ``args``."""
    return spark.sql(sql, args=args or None)
