"""Backtests, recursive forecasts and permutation importance."""

import pytest
from pyspark.sql import functions as F
from tiny import by_key

import meterlab as m
from meterlab.catalog.fixtures import CUTOFF, readings_signal
from meterlab.plans.backtest import folds
from meterlab.plans.forecast_run import fit_and_forecast, make_features
from meterlab.plans.recursive import last_values

CUTOFFS = ["2024-01-12 00:00:00", "2024-01-20 00:00:00"]


@pytest.fixture(scope="module")
def signal(spark):
    return readings_signal(spark, "/root/testdata/sf0.01").where("meter_id < 60").cache()


def config(**changes):
    return m.ForecastConfig(**({"cutoff": CUTOFF, "label": "target", "params": {"maxIter": 3, "maxDepth": 3}} | changes))


def test_no_fold_sees_later_labels(spark, signal):
    """Labels from the cutoff on do not reach the model of a fold."""
    one = m.backtest(signal, config(), CUTOFFS, "2 days")
    late = F.col("ts") >= F.lit(CUTOFFS[0]).cast("timestamp_ntz")
    changed = signal.withColumn("target", F.when(late, F.col("target") * 100).otherwise(F.col("target")))
    two = m.backtest(changed, config(), CUTOFFS, "2 days")
    first = lambda df: by_key(df.where(F.col("cutoff") == F.lit(CUTOFFS[0]).cast("timestamp_ntz")), "prediction")
    a, b = first(one), first(two)
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    assert one.select("cutoff").distinct().count() == 2
    scores = {str(r.cutoff): r for r in m.backtest_errors(one).collect()}
    assert all(s.n == one.where(F.col("cutoff") == F.lit(c).cast("timestamp_ntz")).count() for c, s in scores.items())


def test_labels_ahead_are_known_before_the_cutoff(spark, signal):
    """With a horizon, a row counts for training only if its label lies before the cutoff."""
    grid = config(label=None, value="target", step="hour", horizon=5, agg="max", lags=(), rolling=())
    df, _ = make_features(signal, grid)
    (training, test), = folds(df, CUTOFFS[:1], "1 day", grid)
    latest = training.agg(F.max("ts")).first()[0]
    assert str(latest) == "2024-01-11 18:00:00"
    assert {str(r[0])[:10] for r in test.select("ts").distinct().collect()} == {"2024-01-12"}


def test_backtest_without_rows_to_learn_from(signal):
    found = m.backtest(signal, config(), ["2023-01-01 00:00:00", CUTOFFS[0]], "1 day")
    assert [str(r[0]) for r in found.select("cutoff").distinct().collect()] == [CUTOFFS[0]]
    with pytest.raises(ValueError, match="cutoffs"):
        m.backtest(signal, config(), [])
    with pytest.raises(ValueError, match="impute"):
        m.backtest(signal, config(missing="impute"), CUTOFFS)


@pytest.fixture(scope="module")
def hourly(spark, signal):
    grid = m.regular_grid(signal, "hour", aggs=("mean",), col="target").withColumnRenamed("bucket", "ts")
    return m.fill_forward(grid.withColumnRenamed("target_mean", "load"), "load").select("meter_id", "ts", "load")


def test_one_step_ahead_equals_the_forecast_of_the_next_row(spark, hourly):
    """Lags, trailing statistics and calendar of the state are those of readings."""
    lags, rolling, stats, parts = (1, 3), (2, 5), ("mean", "std", "min", "max", "count", "sum"), ("hour", "weekday")
    known = hourly.where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    last = known.groupBy("meter_id").agg(F.max("ts").alias("ts"))
    step = F.expr("ts + INTERVAL 1 HOUR").alias("ts")
    longer = known.unionByName(last.select("meter_id", step, F.lit(None).cast("double").alias("load")))
    rows = m.history_features(longer, "load", lags, rolling, stats)
    rows = m.calendar_features(rows, parts=parts)
    features = [c for c in rows.columns if c not in ("meter_id", "ts", "load")]
    complete = m.drop_missing(rows, features)
    model = m.train(m.drop_missing(complete, ["load"]), features, "load", {"maxIter": 3, "maxDepth": 3})
    expected = by_key(m.forecast(model, complete.where("load is null")), "ts", "prediction", key="meter_id")
    found = m.recursive_forecast(model, known, 1, "hour", "load", lags, rolling, stats, parts)
    found = by_key(found.where("prediction is not null"), "ts", "prediction", key="meter_id")
    assert found.keys() == expected.keys() and found
    for k, (at, value) in expected.items():
        assert found[k][0] == at and found[k][1] == pytest.approx(value, abs=1e-9)


def test_forecasts_enter_the_next_steps(spark, hourly):
    """A hand-made loop over rows gives the same as nested states, over more steps than are nested."""
    known = hourly.where("meter_id < 5").where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    rows = m.history_features(known, "load", (1, 2), (3,), ("mean",))
    features = ["load_lag_1", "load_lag_2", "load_roll_3_mean"]
    model = m.train(m.drop_missing(rows, [*features, "load"]), features, "load", {"maxIter": 2, "maxDepth": 2})
    found = m.recursive_forecast(model, known, 6, "hour", "load", (1, 2), (3,))
    series = {}
    for r in known.orderBy("ts").collect():
        series.setdefault(r.meter_id, []).append(r.load)
    for n in range(1, 7):
        state = [(k, v[-1], v[-2], sum(v[-3:]) / 3) for k, v in series.items() if len(v) >= 3]
        df = spark.createDataFrame(state, "meter_id long, load_lag_1 double, load_lag_2 double, load_roll_3_mean double")
        step = by_key(m.forecast(model, df), "prediction", key="meter_id")
        got = by_key(found.where(F.col("step_ahead") == n), "prediction", key="meter_id")
        assert {k: pytest.approx(v, abs=1e-9) for k, v in step.items()} == {k: got[k] for k in step}
        for k, v in step.items():
            series[k].append(v)


def test_state_of_few_rows(spark):
    rows = [(1, "2024-01-01 00:00:00", None), (1, "2024-01-01 01:00:00", 2.0), (2, None, 5.0), (None, "2024-01-01 00:00:00", 1.0)]
    df = spark.createDataFrame(rows, "meter_id long, ts string, power_kw double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    state = {r.meter_id: list(r["_past"]) for r in last_values(df, "power_kw", 3, ["meter_id"], ["ts"]).collect()}
    assert state == {1: [None, 2.0], None: [1.0]}
    with pytest.raises(ValueError):
        m.recursive_forecast(None, df, 0)
    with pytest.raises(ValueError):
        m.recursive_forecast(None, df, 1, lags=())


def test_importance(spark, signal):
    settings = config(params={"maxIter": 5, "maxDepth": 3})
    df, features = make_features(signal.withColumn("constant", F.lit(1.0)), settings)
    model, forecasts = fit_and_forecast(df, [*features, "constant"], settings)
    rows = forecasts.drop("prediction")
    one = by_key(m.permutation_importance(model, rows, [*features, "constant"], repeats=2), "rmse", "loss", key="feature")
    assert max(one, key=lambda f: one[f][1]) == "hour" and one["constant"][1] == pytest.approx(0, abs=1e-12)
    assert len(one) == len(features) + 1
    # Other groups shuffle otherwise, and say the same.
    two = by_key(m.permutation_importance(model, rows, [*features, "constant"], group_rows=50), "rmse", "loss", key="feature")
    assert two["hour"][1] == pytest.approx(one["hour"][1], rel=0.3)
    assert m.permutation_importance(model, rows.limit(0), [*features, "constant"]).where("loss is not null").count() == 0
