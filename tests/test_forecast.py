import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.operators import series, windows
from gaugeline.plans import forecast, model
from gaugeline.sources import dims
from tests.frames import close, hour

KEY = ["station_id"]
SCHEMA = "station_id string, hour timestamp, water_level double, flow_rate double, rainfall double, temperature double"


def level(station, h):
    return 10 + station + 2 * math.sin(2 * math.pi * (h + 3 * station) / 24)


def dense(spark, hours=200, stations=3, noise=0.0):
    rng = np.random.default_rng(7)
    rows = [(f"S00{s + 1}", hour(h), level(s, h) + float(noise * rng.normal()), level(s, h) * 10 + float(rng.normal()),
             float(rng.uniform(0, 3)), 20 + 5 * math.sin(2 * math.pi * h / 24))
            for s in range(stations) for h in range(hours)]
    return spark.createDataFrame(rows, SCHEMA)


def test_scorers(spark):
    history = forecast.histories(dense(spark, 100), KEY, "hour")
    for name in forecast.SCORERS:
        for r in forecast.score(history, name).collect():
            s, got = int(r["station_id"][-1]) - 1, r["predicted"]
            assert len(got) == 24
            if name == "persistence":
                assert all(close(x, level(s, 99)) for x in got)
            elif name == "seasonal_naive":
                assert all(close(x, level(s, 100 + i), 1e-7) for i, x in enumerate(got))
            else:
                y = [level(s, h) for h in range(28, 100)]
                line = np.polyfit(range(1, 73), y, 1)
                assert all(close(x, np.polyval(line, 73 + i), 1e-7) for i, x in enumerate(got))


def test_results_and_records(spark):
    rows = dense(spark, 100).withColumn("water_level", F.col("water_level") * 2)
    results = forecast.forecast_all(rows, dims.stations(spark), as_of="2024-02-01 00:00:00").collect()
    assert len(results) == 3
    for r in results:
        s = int(r["location_id"][-1]) - 1
        peak = max(2 * level(s, h) for h in range(100, 124))
        assert close(r["max_predicted_water_level"], peak, 0.01) and len(r["hourly_predictions"]) == 24
        assert r["risk_level"] == sum(peak >= t[2] for t in C.WARNING_THRESHOLDS)
        assert [p["hour"] for p in r["hourly_predictions"]] == list(range(1, 25))
    assert {r["station_name"] for r in results} == {"upper reach", "middle reach", "lower reach"}
    records = forecast.prediction_records(forecast.forecast_all(rows, dims.stations(spark)), "v1")
    assert records.count() == 72


@pytest.mark.parametrize("n", [71, 72, 73])
def test_short_histories(spark, n):
    rows = dense(spark, n, 1)
    assert forecast.forecast_all(rows, dims.stations(spark)).count() == (n >= 72)
    short = forecast.too_short(rows, KEY).collect()
    assert [r["reason"] for r in short] == (["insufficient history: 71 of 72 rows"] if n < 72 else [])


def test_tail_is_enough_for_a_forecast(spark):
    sparse = dense(spark, 300).filter("pmod(hash(hour), 3) = 0")
    whole = series.dense_series(sparse, KEY, "hour", C.FEATURES)
    a = forecast.forecast_all(whole, dims.stations(spark)).drop("predict_time").orderBy("location_id").collect()
    b = forecast.forecast_all(forecast.recent_series(sparse), dims.stations(spark)).drop("predict_time")
    assert a == b.orderBy("location_id").collect()


def test_split(spark):
    rows = model.time_split(dense(spark, 101, 2), KEY, "hour", 0.8, block="1 day")
    assert [r["count"] for r in rows.filter("is_train").groupBy(*KEY).count().collect()] == [81, 81]
    assert model.time_split(dense(spark, 50, 1), KEY, "hour", cutoff=hour(9)).filter("is_train").count() == 10


def pairs(rows):
    return windows.training_pairs(rows, KEY, "hour", C.FEATURES, horizon=24, chunk=128)


def test_fit_equals_a_direct_solve(spark):
    rows = dense(spark, 180, 2, 0.1)
    train = pairs(rows)
    fitted = model.fit(train, strengths=(0.05,))
    local = train.collect()
    x = np.array([[1.0, *np.ravel(r["window"])] for r in local])
    y = np.array([r["label"] for r in local])
    n, p = x.shape
    penalty = np.eye(p) * 0.05 * n
    penalty[0, 0] = 0
    beta = np.linalg.solve(x.T @ x + penalty, x.T @ y)
    assert np.allclose(fitted.intercepts, beta[0]) and np.allclose(fitted.weights, beta[1:].T)
    assert close(fitted.losses[0][2], float(((x @ beta - y) ** 2).mean()), 1e-6)
    assert fitted.parameters["windows"] == len(local) == 2 * (180 - 72 - 24 + 1)


def test_fit_select_save_load_and_forecast(spark, tmp_path):
    rows = dense(spark, 400, 3, 0.05)
    split = model.time_split(rows, KEY, "hour", 0.7)
    calls = []
    fitted = model.fit(pairs(split.filter("is_train")), pairs(split.filter("NOT is_train")),
                       callback=lambda *args: calls.append(args), parameters={"features": C.FEATURES})
    assert [c[0] for c in calls] == [1, 2, 3, 4] and len(fitted.losses) == 4
    held = {entry[1]: entry[3] for entry in fitted.losses}
    assert held[fitted.strength] == min(held.values()) < 0.2
    history = fitted.loss_history(spark)
    assert history.count() == 4 and history.filter("validation_loss IS NULL").count() == 0
    fitted.save(spark, str(tmp_path / "m"))
    loaded = model.LevelModel.load(spark, str(tmp_path / "m"))
    assert np.array_equal(loaded.weights, fitted.weights) and loaded.losses == fitted.losses
    assert (loaded.version, loaded.strength, loaded.parameters) == (fitted.version, fitted.strength, fitted.parameters)
    scored = forecast.score(forecast.histories(rows, KEY, "hour"), loaded)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    for r in scored.collect():
        s = int(r["station_id"][-1]) - 1
        assert max(abs(x - level(s, 400 + i)) for i, x in enumerate(r["predicted"])) < 0.6


def test_no_validation_set(spark):
    fitted = model.fit(pairs(dense(spark, 120, 1, 0.1)), strengths=(1.0, 0.1))
    assert fitted.strength == 0.1 and [e[3] for e in fitted.losses] == [None, None]
    assert fitted.loss_history(spark).filter("validation_loss IS NULL").count() == 2
    with pytest.raises(ValueError):
        model.fit(None, strengths=(0.0,))


def test_mean_squared_error(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 4.0), ("b", 0.0, None)], "k string, predicted double, actual double")
    got = {r["k"]: (r["mse"], r["n"]) for r in forecast.mean_squared_error(df, ["k"]).collect()}
    assert got == {"a": (5.0, 2), "b": (None, 0)}
