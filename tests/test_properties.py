"""Properties that hold for any readings."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from tiny import SCHEMA, at, by_key

import meterlab as m

ORDER = ["ts", "event_id"]
reading = st.tuples(
    st.sampled_from([1, 1, 1, 2, None]),
    st.integers(0, 60 * 24 * 3),
    st.one_of(st.none(), st.integers(-50, 50).map(float)),
)
some_readings = st.lists(reading, min_size=1, max_size=40)
few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, rows):
    start = at("2024-02-28 00:00:00")
    data = [(i, meter, start, v) for i, (meter, _, v) in enumerate(rows)]
    minutes = F.element_at(F.array(*[F.lit(t) for _, t, _ in rows]), (F.col("event_id") + 1).cast("int"))
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumn("ts", F.timestamp_add("MINUTE", minutes, F.col("ts")))


@few
@given(some_readings)
def test_grid_has_no_gap_and_no_duplicate(spark, rows):
    df = frame(spark, rows)
    cells = sorted((str(r.meter_id), r.bucket, r.n_readings) for r in m.regular_grid(df).collect())
    assert sum(n for *_, n in cells) == len(rows)
    for (a, t, _), (b, u, _) in zip(cells, cells[1:], strict=False):
        assert a != b or (u - t).total_seconds() == 3600


@few
@given(some_readings, st.sampled_from([1, 3, 1_000]))
def test_forward_fill_changes_no_present_value(spark, rows, block_rows):
    filled = by_key(m.fill_forward(frame(spark, rows), order=ORDER, block_rows=block_rows), "power_kw")
    assert len(filled) == len(rows)
    latest = {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][1], i)):
        meter, _, value = rows[i]
        latest[meter] = value if value is not None else latest.get(meter)
        assert filled[i] == latest[meter]


@few
@given(some_readings, st.integers(0, 39), st.sampled_from([4, 1_000]))
def test_history_does_not_see_its_own_row_or_later_ones(spark, rows, at_row, block_rows):
    at_row %= len(rows)
    moment = (rows[at_row][1], at_row)
    changed = [
        (meter, t, 999.0 if (t, i) >= moment else v) for i, (meter, t, v) in enumerate(rows)
    ]
    cols = ["power_kw_lag_1", "power_kw_roll_3_mean", "power_kw_roll_3_max"]

    def features(data):
        df = m.history_features(
            frame(spark, data), rolling=(3,), stats=("mean", "max"), order=ORDER, block_rows=block_rows
        )
        return by_key(df, *cols)

    before, after = features(rows), features(changed)
    for i, (_, t, _) in enumerate(rows):
        if (t, i) <= moment:
            assert before[i] == after[i]


@few
@given(some_readings, st.floats(0.05, 0.95))
def test_splits_are_disjoint_and_complete(spark, rows, share):
    df = frame(spark, rows)
    for parts in (m.split_by_key(df, "event_id", share), m.split_by_time(df, "2024-02-29 00:00:00")):
        a, b = (set(by_key(p, "ts")) for p in parts)
        assert not a & b and a | b == set(range(len(rows)))
