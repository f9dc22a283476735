"""Run table, stored models and stored scaler / encoder state."""
import random

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hourcast.operators import encode
from hourcast.operators import models as md
from hourcast.operators import registry as rg
from hourcast.operators import stored_state as ss


@pytest.fixture(scope="module")
def rows(spark):
    data = [(float(i % 13), float((i * 7) % 11), 3.0 * (i % 13) - (i * 7) % 11 + (i % 3) / 10) for i in range(200)]
    return spark.createDataFrame(data, "a double, b double, label double").cache()


def linear():
    return LinearRegression(featuresCol="features", labelCol="label")


def test_loaded_model_predicts_what_the_fitted_one_did(spark, rows, tmp_path):
    root = str(tmp_path / "r")
    fitted = md.fit_models(rows, ["a", "b"], {"Linear": linear()})["Linear"][0]
    rg.log_run(spark, root, "Linear", fitted, 0.1, params={"k": 1})
    loaded = rg.load_model(rg.best_run(spark, root, "Linear"))
    want = [r.prediction for r in fitted.transform(rows).collect()]
    assert [r.prediction for r in loaded.transform(rows).collect()] == want
    assert rg.runs(spark, root).first()["params"] == {"k": "1"}


def test_lowest_rmse_by_name_and_versions(spark, rows, tmp_path):
    root = str(tmp_path / "r")
    with pytest.raises(LookupError):
        rg.best_run(spark, root)
    assert rg.runs(spark, root).collect() == [] and rg.evaluate_runs(spark, root, ["x"], rows).collect() == []
    report = rg.train_and_log(rows, rows, ["b"], {"Linear": linear()}, root, "_b")
    rg.train_and_log(rows, rows, ["a", "b"], {"Linear": linear()}, root, "_ab")
    rg.log_run(spark, root, "broken", rg.load_model(rg.best_run(spark, root)), float("nan"))
    assert [r["name"] for r in report.collect()] == ["Linear_b"]
    assert [r["name"] for r in rg.runs(spark, root).collect()] == ["Linear_ab", "Linear_b", "broken"]  # NaN last
    best = rg.best_run(spark, root)
    assert best["name"] == "Linear_ab" and rg.best_run(spark, root, "Linear_b")["rmse"] > best["rmse"]
    again = rg.evaluate_runs(spark, root, ["Linear_b", "Linear_ab", "unknown"], rows).collect()
    assert [r["Model"] for r in again] == ["Linear_ab", "Linear_b"] and again[0]["RMSE"] == pytest.approx(best["rmse"])
    assert [rg.promote(spark, root, rg.best_run(spark, root, n), "prod") for n in ("Linear_b", "Linear_ab")] == [1, 2]
    assert rg.versions(spark, root, "prod").first()["run_name"] == "Linear_ab"
    assert rg.production_model(spark, root, "prod").transform(rows).count() == 200
    with pytest.raises(LookupError):
        rg.production_model(spark, root, "other")


def test_boosting_stops_on_validation(spark):
    rng = random.Random(5)
    data = [(x := rng.random(), (x > 0.5) + rng.gauss(0, 1), i % 2) for i in range(1200)]  # a step under noise: later trees fit the noise
    df = spark.createDataFrame(data, "x double, label double, part int")
    train, val = df.where("part = 0"), df.where("part = 1")
    stopped = md.boosted_with_stop(train, val, ["x"], max_iter=25)
    full = md.fit_models(train, ["x"], {"GBT": md.regressors(n_estimators=25)["GBT"]})["GBT"][0]
    score = lambda m: md.rmse(m.transform(val)).first()["RMSE"]
    assert stopped.stages[-1].getNumTrees < full.stages[-1].getNumTrees == 25
    assert score(stopped) <= score(full) + 1e-9


def state_rows(spark):
    train = spark.createDataFrame([(float(i), f"brand{i % 12}", "xyz"[i % 3], i) for i in range(60)], "v double, brand string, kind string, id long")
    new = spark.createDataFrame([(100.0, "brand3", "x", 1, "extra"), (None, "other", "w", 2, "extra"), (5.0, None, None, 3, None)],
                                "v double, brand string, kind string, id long, more string")
    return train, new


@pytest.mark.parametrize("unseen", [False, True])
def test_second_job_uses_the_stored_state_only(spark, tmp_path, unseen):
    train, new = state_rows(spark)
    state, prepared = ss.fit(train, ["v"], ["brand", "kind"], unseen_token=unseen, one_hot_type="int")
    assert ss.save(state, str(tmp_path / "s")) == 1
    got = ss.apply(new, ss.load(spark, str(tmp_path / "s")))
    assert got.columns == prepared.columns and set(got.columns) == {"v", "brand", "id", "kind_x", "kind_y", "kind_z"}
    by = {r["id"]: r for r in got.collect()}
    assert by[1]["v"] == (100.0 - 29.5) / 29.5 and by[1]["brand"] == sorted([f"brand{i}" for i in range(12)] + ["unseen"] * unseen).index("brand3")
    assert by[1]["kind_x"] == 1 and [by[2][c] for c in ("kind_x", "kind_y", "kind_z")] == [0, 0, 0]
    assert by[2]["brand"] == (12 if unseen else -1) and by[2]["v"] is None
    direct = encode.apply_encoders(encode.apply_robust_scaler(train, state.scaler), state.encoders, unseen, "int")
    assert sorted(map(str, ss.apply(train, ss.load(spark, str(tmp_path / "s"))).collect())) == sorted(map(str, direct.collect()))


def test_versions_of_the_state(spark, tmp_path):
    root = str(tmp_path / "s")
    with pytest.raises(LookupError):
        ss.load(spark, root)
    train, _ = state_rows(spark)
    first, _ = ss.fit(train, ["v"], ["kind"])
    assert ss.save(first, root) == 1
    ss.fit(train.where("v < 30"), ["v"], ["kind"])[0].scaler.write.parquet(f"{root}/version=2/scaler")  # a job that died on the way
    assert ss.load(spark, root).version == 1
    second, _ = ss.fit(train.where("v < 30"), ["v"], ["kind"])
    assert ss.save(second, root) == 2 and ss.load(spark, root).version == 2
    assert ss.load(spark, root, 1).scaler.first()["median"] == 29.5 and ss.load(spark, root).scaler.first()["median"] == 14.5
    assert {r["column"]: r["n"] for r in ss.categories(second).collect()} == {"kind": 3}
    with pytest.raises(LookupError):
        ss.load(spark, root, 3)
