"""Fits read every row they are given: no bound, hash or sample lies between the prepared rows and the models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourcast.operators import models as md
from hourcast.plans import pipelines as pl
from hourcast.plans import q_model as qm
from hourcast.plans import q_stored as qs

T0 = "timestamp_ntz'2020-01-01 00:00:00'"


class Fitted(Exception):
    pass


@pytest.fixture
def counted(monkeypatch):
    """The rows that reach a fit, which then ends the query."""
    seen = []

    def stop(*frames, **kw):
        seen.extend(f.count() for f in frames if hasattr(f, "count") and hasattr(f, "schema"))
        raise Fitted

    monkeypatch.setattr(md, "fit_models", stop)
    monkeypatch.setattr(md, "boosted_with_stop", stop)
    return seen


def _events(spark, tmp_path, hours):
    """One event an hour of one station."""
    rows = spark.range(hours).select(F.col("id").alias("event_id"), F.expr(f"{T0} + make_dt_interval(0, cast(id as int))").alias("ts"),
                                     F.lit(4).cast("long").alias("user_id"), F.lit("view").alias("event_type"),
                                     (F.col("id") % 24 + F.col("id") % 7 / 10).alias("value"), F.lit('{"k": 1}').alias("props"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_train_and_score_fits_all_rows(spark, monkeypatch, counted):
    n = 120_000
    rows = spark.range(n).select(F.lit("A").alias("StationID"), F.expr(f"{T0} + make_dt_interval(0, 0, cast(id as int))").alias("ObservationTime"),
                                 (F.col("id") % 101 / 2).alias("Temperature"), (F.col("id") % 13).cast("double").alias("wind"))
    monkeypatch.setattr(pl, "training_data", lambda *a, **kw: {"train": rows, "val": rows.limit(100)})
    with pytest.raises(Fitted):
        pl.train_and_score(rows, md.regressors())
    assert counted == [n - 1]  # the last row has no next one


def test_boosted_with_stop_fits_all_rows(spark, tmp_path, counted):
    n = 103_000
    with pytest.raises(Fitted):
        qs.q_boosted_with_stop(spark, _events(spark, tmp_path, n))
    assert counted == [n - 24 - 168, 168]  # 23 rows lack a lag, one row before the last week has its label in it


def test_fit_rows_keeps_all_rows_and_bounds_a_task(spark, monkeypatch):
    monkeypatch.setattr(md, "FIT_TASK_ROWS", 100)
    for parts in (2, 50):
        kept = md.fit_rows(spark.range(2000, numPartitions=parts).select("id", (F.col("id") % 7).alias("k")))
        sizes = kept.rdd.glom().map(len).collect()
        assert len(sizes) == 20 and max(sizes) <= 200
        assert sorted(r["id"] for r in kept.collect()) == list(range(2000))


def _pairs(positions, last, horizon):
    return sum(max(0, min(horizon, last - p)) for p in positions)


def test_tree_models_fit_every_anchor(spark, tmp_path):
    n = 1000
    _, train, val = qm._rows(spark, _events(spark, tmp_path, n))
    cut = n - 168
    assert train.count() == _pairs(range(24, cut), cut, 168) > 100_000
    assert val.count() == _pairs(range(24, n), n, 168) - train.count()
    assert set(md.feature_columns()) | {"label"} == set(train.columns)


def test_forecast_fits_every_anchor(spark, tmp_path, counted):
    n = 1000
    with pytest.raises(Fitted):
        qm._forecast(spark, _events(spark, tmp_path, n))
    assert counted == [_pairs(range(24, n), n, 168)]


def test_batch_inference_fits_every_anchor(spark, tmp_path, counted):
    n = 36_000
    with pytest.raises(Fitted):
        qm._inference(spark, _events(spark, tmp_path, n))
    assert counted == [_pairs(range(24, n - 168), n - 168, 3)]


def test_labelled_steps_joins_each_label_once(spark):
    """Repeated and missing keys and times: one row for each label that lies whole hours after the anchor."""
    t = dt.datetime(2024, 1, 1)
    rows = [("A", t + dt.timedelta(hours=h), float(h)) for h in (0, 1, 1, 3)] + [(None, t, 1.0), ("A", None, 2.0)]
    df = spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, Temperature double")
    anchors = df.filter(F.col("Temperature") == 0).select("StationID", "ObservationTime", F.col("Temperature").alias("lag_0"))
    got = md.labelled_steps(anchors, df, ["StationID"], "ObservationTime", "Temperature", 4).orderBy("h").collect()
    assert [(r["h"], r["label"], r["target_hour"], r["target_weekday"]) for r in got] == [(1, 1.0, 1, 0), (1, 1.0, 1, 0), (3, 3.0, 3, 0)]
