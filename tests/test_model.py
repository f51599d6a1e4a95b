import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F
from tiny import at, by_key, table

import meterlab as m
from meterlab.catalog.fixtures import CUTOFF, readings, readings_signal
from meterlab.operators.model import bin_stage, cells
from meterlab.plans import forecast_run
from meterlab.plans.forecast_run import fit_and_forecast, make_features


@pytest.fixture(scope="module")
def signal(spark):
    return readings_signal(spark, "/root/testdata/sf0.01").persist()


def config(**changes):
    return m.ForecastConfig(**({"cutoff": CUTOFF, "label": "target"} | changes))


@pytest.fixture(scope="module")
def fitted(spark, signal):
    df, features = make_features(signal, config())
    df = df.persist()
    return (df, features, *fit_and_forecast(df, features, config()))


def test_model_finds_the_planted_signal(fitted):
    df, features, _, forecasts = fitted
    assert features == ["power_kw_lag_1", "power_kw_roll_3_mean", "hour", "weekday"]
    model_rmse = m.rmse(forecasts).first().rmse
    mean = m.naive_forecast(df, "mean", col="label", by=(), cutoff=CUTOFF)
    mean_rmse = m.rmse(m.split_by_time(mean, CUTOFF)[1], pred="forecast").first().rmse
    assert model_rmse < 0.05
    assert model_rmse < 0.1 * mean_rmse


def test_run_equals_its_steps(spark, signal, fitted):
    forecasts = fitted[3]
    whole = m.score(m.run(spark, signal, config())).first()
    steps = m.score(forecasts).first()
    assert whole.n == steps.n
    assert whole.rmse == pytest.approx(steps.rmse, abs=1e-9)


def test_test_labels_do_not_reach_the_model(fitted):
    df, features, model, forecasts = fitted
    changed = df.withColumn("label", F.when(F.col("ts") >= CUTOFF, 99.0).otherwise(F.col("label")))
    other, again = fit_and_forecast(changed, features, config())
    trees, same = (x.stages[-1].toDebugString.split("\n", 1)[1] for x in (model, other))
    assert trees == same
    a, b = by_key(forecasts, "prediction"), by_key(again, "prediction")
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-12


def test_scaling_leaves_trees_as_they_are(fitted):
    df, features, _, forecasts = fitted
    _, scaled = fit_and_forecast(df, features, config(scale="minmax"))
    assert m.rmse(scaled).first().rmse == pytest.approx(m.rmse(forecasts).first().rmse, rel=0.2)


def test_imputing_keeps_rows_without_history(spark, signal):
    small = {"maxIter": 2, "maxDepth": 3}
    meter = signal.where("meter_id < 20")
    imputed = m.run(spark, meter, config(missing="impute", params=small))
    _, test = m.split_by_time(meter, CUTOFF)
    assert imputed.count() == test.count()
    dropped = m.run(spark, meter, config(params=small))
    assert dropped.count() <= imputed.count()


def test_more_features_and_text_input(spark, tmp_path):
    rows = readings(spark, "/root/testdata/sf0.001").select(
        F.date_format("ts", "d/M/yyyy").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.col("event_id").cast("string").alias("id"),
        F.concat_ws(" ", F.date_format("ts", "d/M/yyyy HH:mm:ss")).alias("when"),
        F.col("meter_id").cast("string").alias("meter"),
        F.when(F.col("event_id") % 9 == 0, "?").otherwise(F.col("power_kw").cast("string")).alias("power"),
    )
    columns = ["id", "when", "meter", "power"]
    rows.select(*columns).write.csv(str(tmp_path / "t"), sep=";", header=True)
    schema = m.READINGS_SCHEMA
    run = m.ForecastConfig(
        cutoff=CUTOFF,
        schema=type(schema)([f for f in schema if f.name != "channel"]),
        text_columns=columns,
        sep=";",
        rename={"id": "event_id", "when": "ts", "meter": "meter_id", "power": "power_kw"},
        patterns={"ts": "d/M/yyyy HH:mm:ss"},
        missing="forward",
        lags=(1, 2),
        delta=True,
        flags=True,
        cycles=("hour",),
        params={"maxIter": 2, "maxDepth": 2},
    )
    forecasts = m.run(spark, str(tmp_path / "t"), run)
    assert {"power_kw_last_change", "is_weekend", "hour_sin"} <= set(forecasts.columns)
    keys = by_key(forecasts, "label", "prediction")
    assert keys and all(p is not None for _, p in keys.values())
    assert all((label is None) == (k % 9 == 0) for k, (label, _) in keys.items())


def test_rows_without_a_label_get_forecasts(spark, signal):
    unknown = signal.withColumn("target", F.when(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"), F.col("target")))
    small = config(params={"maxIter": 2, "maxDepth": 3})
    known = by_key(m.run(spark, signal, small), "prediction")
    found = by_key(m.run(spark, unknown, small), "label", "prediction")
    assert known.keys() == found.keys() and all(label is None for label, _ in found.values())
    # The same trees; sums of files of other sizes may differ in their last bits.
    assert all(abs(known[k] - p) < 1e-9 for k, (_, p) in found.items())


def test_equal_rows_learn_as_one(spark):
    """As many rows to boost as there are different features, and the trees of all rows."""
    df = spark.range(4_000).select(
        (F.col("id") % 24).cast("int").alias("hour"), (F.col("id") % 7).cast("int").alias("day"),
        ((F.col("id") * 7_919 % 101) / 100 + F.sin(F.col("id") % 24)).alias("label"),
    )
    params = {"maxIter": 5, "maxDepth": 4, "seed": 42}
    merged = cells(df, ["hour", "day"])
    assert merged.table.count() == 168 and merged.table.agg(F.sum("_weight")).first()[0] == 4_000
    found = m.forecast(m.train(df, ["hour", "day"], params=params), df)
    assert set(found.columns) == {"hour", "day", "label", "prediction"}
    boosting = GBTRegressor(featuresCol="features", labelCol="label", **params)
    single = Pipeline(stages=[m.assemble_stage(["hour", "day"]), boosting]).fit(df).transform(df)
    keys = ["hour", "day"]
    both = found.groupBy(*keys).agg(F.max("prediction").alias("a")).join(single.groupBy(*keys).agg(F.max("prediction").alias("b")), keys)
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).isEmpty()


def test_bins_hold_about_equal_numbers_of_rows(spark):
    df = spark.range(6_400).select(
        (F.col("id") * 1.5).alias("even"), (F.col("id") % 9).alias("few"),
        F.when(F.col("id") < 5_000, 3.0).otherwise(F.col("id") * 1.0).alias("common"),
    )
    stage = bin_stage(df, ["even", "few", "common"])
    assert stage.getInputCols() == ["even", "common"]
    binned = stage.transform(df)
    sizes = [r["count"] for r in binned.groupBy("_bin_even").count().collect()]
    assert len(sizes) == 32 and max(sizes) <= 201
    assert binned.groupBy("_bin_common").count().agg(F.max("count")).first()[0] == 5_000
    assert m.train(df.withColumn("label", F.col("even")), ["even"], params={"maxIter": 2, "subsamplingRate": 0.5}).stages[-1].getNumTrees == 2


def test_steps_without_readings_are_not_made_to_be_dropped(spark, monkeypatch):
    df = table(spark, [(1, f"2024-01-{d:02d} {h:02d}:10:00", v) for d, h, v in ((1, 0, 1.0), (1, 2, 3.0), (1, 3, None), (9, 1, 5.0), (9, 3, 7.0))])
    grid = m.direct_label(m.regular_grid(df, "hour", aggs=("max",)), "power_kw_max", 2, unique=True)
    expected = by_key(grid.where("power_kw_max is not null"), "power_kw_max", "label", key="bucket")
    monkeypatch.setattr(forecast_run, "regular_grid", None)
    found, _ = make_features(df, config(label=None, step="hour", horizon=2, agg="max", lags=(), rolling=()))
    assert by_key(found, "power_kw_max", "label", key="ts") == expected and len(expected) == 4


def test_refusals(signal):
    with pytest.raises(ValueError, match="step"):
        make_features(signal, config(horizon=2))
    with pytest.raises(ValueError, match="lags 1 and 2"):
        make_features(signal, config(delta=True))
    with pytest.raises(ValueError, match="missing"):
        make_features(signal, config(missing="guess"))
    with pytest.raises(ValueError, match="cutoff"):
        m.naive_forecast(signal, "mean")
    with pytest.raises(ValueError, match="naive"):
        m.naive_forecast(signal, "oracle")
    with pytest.raises(ValueError, match="scaling"):
        m.scale_stage("log")


def test_assemble_stage_refuses_missing_values_by_default(spark):
    df = table(spark, [(1, "2024-01-01 00:00:00", None)])
    with pytest.raises(Exception, match="null|Null|NULL"):
        m.assemble_stage(["power_kw"]).transform(df).collect()
    assert m.assemble_stage(["power_kw"], "skip").transform(df).count() == 0


def test_split_by_key_ignores_partitioning(spark, signal):
    one = m.split_by_key(signal, "event_id", 0.8)[0].select("event_id")
    two = m.split_by_key(signal.repartition(7), "event_id", 0.8)[0].select("event_id")
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert 0.77 < one.count() / signal.count() < 0.83


def test_split_by_time_edges(spark):
    df = table(spark, [(1, "2024-01-24 23:59:59", 1.0), (1, CUTOFF, 2.0), (1, None, 3.0)])
    training, test = m.split_by_time(df, at(CUTOFF))
    assert (set(by_key(training, "ts")), set(by_key(test, "ts"))) == ({0}, {1})


def test_errors_by_hand(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", 3.0, 2.0), ("b", 5.0, 5.0), ("b", None, 1.0), ("b", 9.0, None)],
        "g string, label double, prediction double",
    )
    row = m.errors(df).first()
    assert (row.n, row.mae, row.bias) == (3, pytest.approx(2 / 3), 0.0)
    assert row.rmse == pytest.approx((2 / 3) ** 0.5)
    assert row.r2 == pytest.approx(1 - (2 / 3) / (8 / 3))
    groups = {r.g: r for r in m.errors(df, by=["g"]).collect()}
    assert groups["b"].n == 1 and groups["b"].rmse == 0.0 and groups["b"].r2 is None
    assert m.rmse(df, by=["g"]).count() == 2


def test_naive_forecasts_by_hand(spark):
    df = table(spark, [(1, "2024-01-01 00:00:00", 2.0), (1, "2024-01-02 00:00:00", 4.0), (2, "2024-01-02 00:00:00", 6.0)])
    cutoff = "2024-01-02 00:00:00"
    assert by_key(m.naive_forecast(df, "mean", cutoff=cutoff), "forecast") == {0: 2.0, 1: 2.0, 2: None}
    assert by_key(m.naive_forecast(df, "mean", by=(), cutoff=cutoff), "forecast") == {0: 2.0, 1: 2.0, 2: 2.0}
    assert by_key(m.naive_forecast(df, "last"), "forecast") == {0: None, 1: 2.0, 2: None}
    assert by_key(m.naive_forecast(df, "season"), "forecast") == {0: None, 1: 2.0, 2: None}
