import math

from tiny import by_key, table

import meterlab as m

NAN = float("nan")
ROWS = [
    (1, "2024-01-01 00:00:00", None),
    (1, "2024-01-01 01:00:00", 2.0),
    (1, "2024-01-01 02:00:00", NAN),
    (1, "2024-01-01 03:00:00", 4.0),
    (2, "2024-01-01 00:00:00", None),
    (None, "2024-01-01 00:00:00", 8.0),
    (None, "2024-01-01 01:00:00", None),
]


def test_null_profile_counts_null_and_nan_apart(spark):
    df = table(spark, ROWS)
    rows = {r["column"]: r for r in m.null_profile(df, ["meter_id", "power_kw"]).collect()}
    assert (rows["meter_id"].n_rows, rows["meter_id"].n_null, rows["meter_id"].n_nan) == (7, 2, 0)
    assert (rows["power_kw"].n_null, rows["power_kw"].n_nan) == (3, 1)
    assert rows["power_kw"].share_missing == 4 / 7


def test_null_profile_of_empty_table(spark):
    row = m.null_profile(table(spark, []), ["power_kw"]).first()
    assert (row.n_rows, row.n_null, row.share_missing) == (0, 0, None)


def test_null_tokens_ignore_blanks(spark):
    df = spark.createDataFrame([(0, " ? "), (1, "5"), (2, ""), (3, None), (4, "N/A")], "event_id int, x string")
    assert by_key(m.null_tokens(df, ["x"]), "x") == {0: None, 1: "5", 2: None, 3: None, 4: None}


def test_drop_missing_any_and_all(spark):
    df = table(spark, ROWS)
    assert set(by_key(m.drop_missing(df, ["meter_id", "power_kw"]), "ts")) == {1, 3}
    assert set(by_key(m.drop_missing(df, ["meter_id", "power_kw"], "all"), "ts")) == {0, 1, 2, 3, 4, 5}


def test_fill_constant_fills_nan_too(spark):
    assert by_key(m.fill_constant(table(spark, ROWS), {"power_kw": 0.0}), "power_kw")[2] == 0.0


def test_fill_mean_per_meter_and_of_all(spark):
    df = table(spark, ROWS)
    assert by_key(m.fill_mean(df), "power_kw") == {
        0: 3.0, 1: 2.0, 2: 3.0, 3: 4.0, 4: None, 5: 8.0, 6: 8.0,
    }
    assert by_key(m.fill_mean(df, by=()), "power_kw")[4] == 14 / 3


def test_fill_mean_beyond_the_broadcast_bound(spark, monkeypatch):
    from meterlab.plans import blocks

    df = table(spark, ROWS)
    expected = by_key(m.fill_mean(df), "power_kw")
    monkeypatch.setattr(blocks, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 3)
    assert by_key(m.fill_mean(df), "power_kw") == expected
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 100)
    assert by_key(m.fill_mean(df), "power_kw") == expected


def test_fill_forward_keeps_leading_nulls_and_present_values(spark):
    filled = by_key(m.fill_forward(table(spark, ROWS), order=["ts", "event_id"]), "power_kw")
    assert filled == {0: None, 1: 2.0, 2: 2.0, 3: 4.0, 4: None, 5: 8.0, 6: 8.0}


def test_fill_forward_over_midnight_gap(spark):
    df = table(spark, [(1, "2024-02-28 23:59:59", 1.0), (1, "2024-03-02 00:00:00", None)])
    assert by_key(m.fill_forward(df), "power_kw") == {0: 1.0, 1: 1.0}


def test_impute_stage_learns_from_what_it_is_fitted_on(spark):
    df = table(spark, ROWS)
    model = m.impute_stage(["power_kw"]).fit(df.where("meter_id = 1"))
    filled = by_key(model.transform(df), "power_kw_filled")
    assert filled[0] == 3.0 and filled[2] == 3.0 and filled[4] == 3.0 and filled[5] == 8.0
    median = m.impute_stage(["power_kw"], "median").fit(df.where("meter_id = 1"))
    assert by_key(median.transform(df), "power_kw_filled")[0] in (2.0, 4.0)
    mode = m.impute_stage(["power_kw"], "mode").fit(df.where("meter_id IS NULL"))
    assert by_key(mode.transform(df), "power_kw_filled")[0] == 8.0


def test_nan_becomes_null_on_entry(spark, tmp_path):
    table(spark, ROWS).selectExpr("*", "'x' AS channel").write.parquet(str(tmp_path / "t"))
    values = by_key(m.read_readings(spark, str(tmp_path / "t")), "power_kw")
    assert values[2] is None
    kept = by_key(m.read_readings(spark, str(tmp_path / "t"), nan_as_null=False), "power_kw")
    assert math.isnan(kept[2])
