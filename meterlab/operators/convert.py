"""Type conversion: bad text becomes NULL, and a report counts it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from meterlab.functions import number, parse_time


def to_number(df: DataFrame, cols: Sequence[str], type: str = "double") -> DataFrame:
    """Convert text columns to numbers; bad text and NaN become NULL."""
    return df.withColumns({c: number(F.col(c), type) for c in cols})


def to_ts(df: DataFrame, cols: Sequence[str] | str, pattern: str, out: str = "ts") -> DataFrame:
    """Parse one text column, or date and time columns joined by a blank.

    A row in which one of the parts is NULL gets NULL.
    """
    parts = [cols] if isinstance(cols, str) else list(cols)
    joined = F.concat_ws(" ", *parts)
    complete = F.when(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in parts)), joined)
    return df.withColumn(out, parse_time(complete, pattern))


def _converted(field: StructField, source: DataType, patterns: Mapping[str, str]) -> Column:
    """The expression that turns a column into the declared type."""
    value, target = F.col(field.name), field.dataType
    if source == target:
        return value
    if isinstance(target, StringType) or not isinstance(source, StringType):
        return value.try_cast(target)
    if isinstance(target, (TimestampNTZType, TimestampType, DateType)):
        if field.name not in patterns:
            return value.try_cast(target)
        return parse_time(value, patterns[field.name]).cast(target)
    return number(value, target.simpleString())


def apply_schema(
    df: DataFrame, schema: StructType, patterns: Mapping[str, str] | None = None
) -> DataFrame:
    """Convert every column of the declared schema in one projection.

    ``patterns`` gives the text pattern of timestamp and date columns; without
    one, ISO text is expected. Columns outside the schema are dropped.
    """
    return df.select(
        *[
            _converted(field, df.schema[field.name].dataType, patterns or {}).alias(field.name)
            for field in schema
        ]
    )


def conversion_report(
    raw: DataFrame, schema: StructType, patterns: Mapping[str, str] | None = None
) -> DataFrame:
    """Per column: values present, and those of them that did not convert."""
    counts = []
    for field in schema:
        value = F.col(field.name)
        converted = _converted(field, raw.schema[field.name].dataType, patterns or {})
        counts += [
            F.count(value).alias(f"{field.name}_present"),
            F.count_if(value.isNotNull() & converted.isNull()).alias(f"{field.name}_failed"),
        ]
    rows = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.col(f"{field.name}_present").alias("n_present"),
            F.col(f"{field.name}_failed").alias("n_failed"),
        )
        for field in schema
    ]
    return raw.agg(*counts).select(F.inline(F.array(*rows)))
