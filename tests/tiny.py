"""Ten-row tables and exact results."""

from datetime import datetime

SCHEMA = "event_id bigint, meter_id bigint, ts timestamp_ntz, power_kw double"


def at(text):
    return datetime.fromisoformat(text)


def table(spark, rows, schema=SCHEMA):
    """Rows of (meter, time text, value); the row key is the position."""
    data = [(i, m, None if t is None else at(t), v) for i, (m, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def by_key(df, *cols, key="event_id"):
    rows = df.select(key, *cols).collect()
    return {r[0]: (r[1] if len(cols) == 1 else tuple(r[1:])) for r in rows}


def same_rows(a, b):
    """Both tables hold the same rows; doubles may differ in the last digits."""
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    key = lambda row: [(v is None, str(v)) for v in row if not isinstance(v, float)]
    left = sorted([tuple(r) for r in a.select(*cols).collect()], key=key)
    right = sorted([tuple(r) for r in b.select(*cols).collect()], key=key)
    assert len(left) == len(right)
    for x, y in zip(left, right, strict=True):
        for name, u, v in zip(cols, x, y, strict=True):
            if isinstance(u, float) and isinstance(v, float):
                assert abs(u - v) <= 1e-9 * max(1.0, abs(u)), (name, x, y)
            else:
                assert u == v, (name, x, y)
