from datetime import date

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)
from tiny import at, by_key

import meterlab as m


def text(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "event_id int, x string")


def test_to_number_bad_text_is_null(spark):
    values = ["1.5", " 2 ", "?", "", None, "5d", "3F", "NaN", "-1e3", "1,5", "Infinity"]
    got = by_key(m.to_number(text(spark, values), ["x"]), "x")
    assert [got[i] for i in range(10)] == [1.5, 2.0, None, None, None, None, None, None, -1000.0, None]
    assert by_key(m.to_number(text(spark, ["7", "7.5", "x"]), ["x"], "int"), "x") == {0: 7, 1: None, 2: None}


def test_to_ts_survives_hours_that_the_session_zone_skips(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    got = by_key(m.to_ts(text(spark, ["10/3/2024 02:30:00", "31/2/2024 00:00:00", None, "x"]), "x", "d/M/yyyy HH:mm:ss"), "ts")
    assert got == {0: at("2024-03-10 02:30:00"), 1: None, 2: None, 3: None}


def test_to_ts_from_two_columns(spark):
    df = spark.createDataFrame(
        [(0, "16/12/2006", "17:24:00"), (1, "16/12/2006", None), (2, None, "17:24:00")],
        "event_id int, d string, t string",
    )
    got = by_key(m.to_ts(df, ["d", "t"], "d/M/yyyy HH:mm:ss"), "ts")
    assert got == {0: at("2006-12-16 17:24:00"), 1: None, 2: None}


SCHEMA = StructType(
    [
        StructField("n", IntegerType()),
        StructField("v", DoubleType()),
        StructField("p", DecimalType(10, 2)),
        StructField("s", StringType()),
        StructField("d", DateType()),
        StructField("t", TimestampNTZType()),
        StructField("iso", TimestampNTZType()),
    ]
)
RAW = [
    ("1", "2.5", "3.25", "a", "31.12.2024", "31.12.2024 23:00", "2024-12-31 23:00:00"),
    ("x", "?", "-", None, "32.12.2024", "31.12.2024", "yesterday"),
    (None, None, None, None, None, None, None),
]
PATTERNS = {"d": "dd.MM.yyyy", "t": "dd.MM.yyyy HH:mm"}


def raw(spark):
    return spark.createDataFrame(RAW, ", ".join(f"{c} string" for c in SCHEMA.names))


def test_apply_schema_converts_every_type(spark):
    df = m.apply_schema(raw(spark), SCHEMA, PATTERNS)
    assert df.schema == SCHEMA
    first, second, third = df.collect()
    assert first.n == 1 and first.v == 2.5 and str(first.p) == "3.25" and first.s == "a"
    assert first.d == date(2024, 12, 31)
    assert first.t == first.iso == at("2024-12-31 23:00:00")
    assert set(second) == {None} and set(third) == {None}


def test_conversion_report_counts_present_and_failed(spark):
    rows = m.conversion_report(raw(spark), SCHEMA, PATTERNS).collect()
    got = {r["column"]: (r.n_present, r.n_failed) for r in rows}
    assert got == {c: (2, 1) for c in ("n", "v", "p", "d", "t", "iso")} | {"s": (1, 0)}
