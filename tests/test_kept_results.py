"""Results that queries keep in the scratch folder: shared within a run, never across changed data."""

from pyspark.sql import functions as F

from hourcast.operators import models as md
from hourcast.plans import q_clean, q_model
from tests.conftest import SF_SMALL


def _events(spark, root, late: bool):
    """The events of two halves of the days; the second one is added as more files."""
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    part = e.where((F.dayofmonth("ts") > 15) == F.lit(late))
    part.write.mode("append").parquet(f"{root}/events.parquet")
    return part.count()


def test_models_are_fitted_again_after_an_append(spark, tmp_path, monkeypatch):
    fits, fit = [], md.fit_models
    family = {"LinearRegression": md.regressors()["LinearRegression"], "RandomForest": md.regressors(n_estimators=2)["RandomForest"]}
    monkeypatch.setattr(md, "regressors", lambda: family)
    monkeypatch.setattr(md, "fit_models", lambda train, features, models: fits.append(1) or fit(train, features, models))
    monkeypatch.setattr(md, "HORIZON", 6)
    root = str(tmp_path)
    scored = lambda: {r["Model"]: (r["RMSE"], r["n_scored"]) for r in q_model.q_tree_models(spark, root).collect()}
    times = lambda: {(r["StationID"], r["month"], r["day"], r["hour"]) for r in q_model.q_forecast_168(spark, root).collect()}
    _events(spark, root, late=False)
    early, early_times = scored(), times()
    assert scored() == early and times() == early_times and len(fits) == 2  # one fit each, shared
    _events(spark, root, late=True)
    late, late_times = scored(), times()
    assert late != early and late_times.isdisjoint(early_times) and len(fits) == 4


def test_lake_follows_appended_and_replaced_files(spark, tmp_path):
    root = str(tmp_path)
    total = lambda: q_clean.q_day_counts(spark, root).agg(F.sum("n_rows")).first()[0]
    n = _events(spark, root, late=False)
    assert total() == n
    m = _events(spark, root, late=True)
    assert m > 0 and total() == n + m
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.where(F.dayofmonth("ts") <= 15).write.mode("overwrite").parquet(f"{root}/events.parquet")
    assert total() == n  # days that the table lost are no days of its lake
