"""NULL handling and type conversion."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

import meterlab as m
from meterlab.catalog.fixtures import (
    CUTOFF,
    ONE_METER_NULL,
    ORDER,
    READINGS_NULL,
    READINGS_RAW,
    one_meter_null,
    readings,
    readings_null,
    readings_raw,
)
from meterlab.catalog.registry import exact_mean, registered, round_sql, rounded
from meterlab.plans.blocks import scratch_path

_RAW_PATTERN = "d/M/yyyy HH:mm:ss"
_RAW_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("power_text", DoubleType()),
        StructField("ts_text", TimestampNTZType()),
    ]
)
_PARSED = "try_strptime(ts_text, '%d/%m/%Y %H:%M:%S')"


@registered(
    f"""WITH {READINGS_NULL}
    SELECT 'power_kw' AS "column", count(*) AS n_rows,
           CAST(count(*) FILTER (WHERE power_kw IS NULL) AS BIGINT) AS n_null,
           CAST(count(*) FILTER (WHERE isnan(power_kw)) AS BIGINT) AS n_nan,
           CAST(count(*) FILTER (WHERE power_kw IS NULL) AS DOUBLE) / count(*) AS share_missing
    FROM readings
    UNION ALL
    SELECT 'channel', count(*), count(*) FILTER (WHERE channel IS NULL), 0,
           CAST(count(*) FILTER (WHERE channel IS NULL) AS DOUBLE) / count(*) FROM readings"""
)
def null_profile(spark, folder):
    return m.null_profile(readings_null(spark, folder), ["power_kw", "channel"])


@registered(
    f"""WITH {READINGS_NULL}
    SELECT count(*) AS n_rows,
           count(*) FILTER (WHERE power_kw IS NULL) AS power_kw_nulls,
           count(*) FILTER (WHERE isnan(power_kw)) AS power_kw_nans,
           CAST(count(*) FILTER (WHERE power_kw IS NULL) AS DOUBLE) / count(*)
             AS power_kw_share_missing
    FROM readings"""
)
def null_profile_wide(spark, folder):
    return m.null_profile(readings_null(spark, folder), ["power_kw"], wide=True)


@registered(
    f"""WITH {READINGS_RAW}
    SELECT event_id, CASE WHEN trim(power_text) IN ('?', '') THEN NULL ELSE power_text END
             AS power_text, ts_text
    FROM readings"""
)
def null_tokens(spark, folder):
    return m.null_tokens(readings_raw(spark, folder), ["power_text"], ["?", ""])


@registered(f"WITH {READINGS_NULL} SELECT * FROM readings WHERE power_kw IS NOT NULL")
def drop_missing(spark, folder):
    return m.drop_missing(readings_null(spark, folder), ["power_kw", "channel"])


@registered(
    f"""WITH {READINGS_NULL}, two AS (
      SELECT *, CASE WHEN event_id % 14 = 0 THEN NULL ELSE channel END AS tag FROM readings)
    SELECT * FROM two WHERE power_kw IS NOT NULL OR tag IS NOT NULL"""
)
def drop_missing_all(spark, folder):
    tag = F.when(F.col("event_id") % 14 != 0, F.col("channel"))
    df = readings_null(spark, folder).withColumn("tag", tag)
    return m.drop_missing(df, ["power_kw", "tag"], how="all")


@registered(
    f"""WITH {READINGS_NULL}
    SELECT event_id, meter_id, ts, coalesce(power_kw, 0.0::DOUBLE) AS power_kw, channel
    FROM readings"""
)
def fill_constant(spark, folder):
    return m.fill_constant(readings_null(spark, folder), {"power_kw": 0.0})


@registered(
    f"""WITH {READINGS_NULL}, means AS (
      SELECT meter_id, {exact_mean("power_kw")} AS mean FROM readings GROUP BY meter_id)
    SELECT event_id, meter_id, ts, coalesce(power_kw, mean) AS power_kw, channel
    FROM readings JOIN means USING (meter_id)"""
)
def fill_mean(spark, folder):
    return m.fill_mean(readings_null(spark, folder), scale=2)


@registered(
    f"""WITH {READINGS_NULL}
    SELECT event_id, meter_id, ts,
           coalesce(power_kw, (SELECT {exact_mean("power_kw")} FROM readings)) AS power_kw, channel
    FROM readings"""
)
def fill_mean_of_all(spark, folder):
    return m.fill_mean(readings_null(spark, folder), by=(), scale=2)


@registered(
    f"""WITH {READINGS_NULL}, learnt AS (
      SELECT avg(power_kw) AS mean FROM readings WHERE ts < TIMESTAMP '{CUTOFF}')
    SELECT event_id, {round_sql("coalesce(power_kw, (SELECT mean FROM learnt))", "power_kw_filled")}
    FROM readings"""
)
def impute_stage(spark, folder):
    """The mean of the training part fills both parts."""
    df = readings_null(spark, folder)
    training, _ = m.split_by_time(df, CUTOFF)
    model = m.impute_stage(["power_kw"]).fit(training)
    return rounded(model.transform(df).select("event_id", "power_kw_filled"), ["power_kw_filled"])


_FORWARD = """WITH {0}
    SELECT event_id, meter_id, ts,
           last_value(power_kw IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS power_kw, channel
    FROM readings"""


@registered(_FORWARD.format(READINGS_NULL))
def fill_forward(spark, folder):
    return m.fill_forward(readings_null(spark, folder), order=ORDER)


@registered(_FORWARD.format(ONE_METER_NULL))
def fill_forward_one_meter(spark, folder):
    return m.fill_forward(one_meter_null(spark, folder), order=ORDER, block_rows=2_000)


@registered(
    f"""WITH {READINGS_RAW}
    SELECT event_id, try_cast(power_text AS DOUBLE) AS power_text, ts_text FROM readings"""
)
def to_number(spark, folder):
    return m.to_number(readings_raw(spark, folder), ["power_text"])


@registered(
    f"""WITH {READINGS_RAW}
    SELECT event_id,
           try_cast(split_part(power_text, '.', 1) AS BIGINT) AS whole
    FROM readings"""
)
def to_whole_number(spark, folder):
    whole = F.split_part("power_text", F.lit("."), F.lit(1)).alias("whole")
    return m.to_number(readings_raw(spark, folder).select("event_id", whole), ["whole"], "bigint")


@registered(
    """SELECT event_id, CASE WHEN event_id % 5 >= 3 THEN value END AS value FROM events"""
)
def to_number_not_finite(spark, folder):
    """Numbers that are not finite, by name or by size, are no readings."""
    odd = F.array(F.lit("Infinity"), F.lit("NaN"), F.lit("-1e400"))
    text = F.coalesce(F.get(odd, (F.col("event_id") % 5).cast("int")), F.col("power_kw").cast("string"))
    df = readings(spark, folder).select("event_id", text.alias("value"))
    return m.to_number(df, ["value"])


@registered(f"WITH {READINGS_RAW} SELECT event_id, {_PARSED} AS ts FROM readings")
def to_ts(spark, folder):
    return m.to_ts(readings_raw(spark, folder), "ts_text", _RAW_PATTERN).select("event_id", "ts")


@registered(
    f"""WITH {READINGS_RAW}
    SELECT event_id, CASE WHEN ts_text <> 'bad' THEN {_PARSED} END AS ts FROM readings"""
)
def to_ts_from_date_and_time(spark, folder):
    halves = readings_raw(spark, folder).select(
        "event_id",
        F.split_part("ts_text", F.lit(" "), F.lit(1)).alias("date_text"),
        F.split_part("ts_text", F.lit(" "), F.lit(2)).alias("time_text"),
    )
    return m.to_ts(halves, ["date_text", "time_text"], _RAW_PATTERN).select("event_id", "ts")


@registered(
    f"""WITH {READINGS_RAW}
    SELECT CAST(event_id AS VARCHAR) AS event_id, try_cast(power_text AS DOUBLE) AS power_text,
           {_PARSED} AS ts_text
    FROM readings"""
)
def apply_schema(spark, folder):
    return m.apply_schema(readings_raw(spark, folder), _RAW_SCHEMA, {"ts_text": _RAW_PATTERN})


@registered(
    f"""WITH {READINGS_RAW}
    SELECT 'event_id' AS "column", count(event_id) AS n_present, CAST(0 AS BIGINT) AS n_failed
    FROM readings
    UNION ALL SELECT 'power_text', count(power_text),
      count(*) FILTER (WHERE power_text IS NOT NULL AND try_cast(power_text AS DOUBLE) IS NULL)
    FROM readings
    UNION ALL SELECT 'ts_text', count(ts_text),
      count(*) FILTER (WHERE ts_text IS NOT NULL AND {_PARSED} IS NULL)
    FROM readings"""
)
def conversion_report(spark, folder):
    return m.conversion_report(readings_raw(spark, folder), _RAW_SCHEMA, {"ts_text": _RAW_PATTERN})


_TEXT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("power_text", DoubleType()),
        StructField("ts_text", TimestampNTZType()),
    ]
)


@registered(
    f"""WITH {READINGS_RAW}, typed AS (
      SELECT event_id, try_cast(power_text AS DOUBLE) AS power_kw, {_PARSED} AS ts FROM readings)
    SELECT * FROM typed WHERE power_kw IS NOT NULL AND ts IS NOT NULL"""
)
def clean_text_table(spark, folder):
    """Text file to typed, complete rows: read, mark missing, convert, drop."""
    path = scratch_path(spark, "text")
    readings_raw(spark, folder).write.csv(path, sep=";", header=True)
    raw = m.read_raw_text(spark, path, _TEXT_SCHEMA.names, sep=";")
    typed = m.apply_schema(
        m.null_tokens(raw, raw.columns), _TEXT_SCHEMA, {"ts_text": _RAW_PATTERN}
    )
    return m.drop_missing(typed.toDF("event_id", "power_kw", "ts"))
