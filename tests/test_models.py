import datetime as dt
import math

from pyspark.sql import functions as F

from hourcast.operators import models as md
from hourcast.plans import q_model as qm
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _series(spark, n, skip=()):
    rows = [("A", T0 + dt.timedelta(hours=h), float(h % 24) + 0.5 * (h // 24)) for h in range(n) if h not in skip]
    return spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, Temperature double"), rows


def test_last_anchor_lags(spark):
    df, rows = _series(spark, 100, skip=(97,))
    a = md.last_anchor(df, ["StationID"], "ObservationTime", "Temperature").collect()
    assert len(a) == 1
    vals = [r[2] for r in rows]
    r = a[0]
    assert r["lag_0"] == vals[-1] and r["lag_1"] == vals[-2] and r["lag_2"] == vals[-3] and r["lag_23"] == vals[-24]


def test_seasonal_naive_and_rmse(spark):
    df, rows = _series(spark, 24 * 5)
    origin = md.backtest_origin(df, ["StationID"], "ObservationTime", horizon=48)
    p = md.seasonal_naive(df, ["StationID"], "ObservationTime", "Temperature", origin, horizon=48)
    by_h = {r["h"]: r["prediction"] for r in p.collect()}
    last = {r[1]: r[2] for r in rows}
    o = T0 + dt.timedelta(hours=24 * 5 - 1 - 48)
    for h in (1, 24, 25, 48):
        src = o + dt.timedelta(hours=h) - dt.timedelta(hours=24 * math.ceil(h / 24))
        assert by_h[h] == last[src]
    scored = md.with_actuals(p, df, ["StationID"], "ObservationTime", "Temperature")
    r = md.rmse(scored).first()
    # each day is 0.5 warmer: steps 1-24 look one day back (error 0.5), steps 25-48 two days (1.0)
    assert math.isclose(r["RMSE"], math.sqrt((24 * 0.25 + 24 * 1.0) / 48)) and r["n"] == 48


def test_training_rows_labels_are_gap_safe(spark):
    df, _ = _series(spark, 60, skip=(40,))
    rows = md.training_rows(df, ["StationID"], "ObservationTime", "Temperature", horizon=3)
    assert rows.filter(F.col("target_time") == T0 + dt.timedelta(hours=40)).count() == 0
    one = rows.filter((F.col("ObservationTime") == T0 + dt.timedelta(hours=30)) & (F.col("h") == 2)).first()
    assert one["label"] == 32 % 24 + 0.5 * (32 // 24) and one["target_hour"] == 8


def test_fit_evaluate_and_forecast(spark):
    df, rows = _series(spark, 24 * 20)
    keys, t = ["StationID"], "ObservationTime"
    all_rows = md.training_rows(df, keys, t, "Temperature", horizon=24)
    train, val = md.before_and_after(all_rows, T0 + dt.timedelta(hours=24 * 17))
    assert train.count() + val.count() == all_rows.count() and val.count() > 0
    fitted = md.fit_models(train, md.feature_columns(), {k: v for k, v in md.regressors(n_estimators=5).items() if k != "GBT"})
    report = md.evaluate_models(fitted, val).collect()
    assert [r["RMSE"] for r in report] == sorted(r["RMSE"] for r in report) and report[0]["RMSE"] < 6.0
    for r in report:  # the report's figure is the root mean square over all validation rows
        assert math.isclose(md.rmse(fitted[r["Model"]][0].transform(val)).first()["RMSE"], r["RMSE"], rel_tol=1e-6)
    assert [r["Model"] for r in md.top_models(md.evaluate_models(fitted, val), 2).collect()] == [r["Model"] for r in report[:2]]
    fc = md.forecast(fitted["LinearRegression"][0], df, keys, t, "Temperature", horizon=48).orderBy("h").collect()
    last = rows[-1][1]
    assert [(r["day"], r["hour"]) for r in fc] == [((last + dt.timedelta(hours=h)).day, (last + dt.timedelta(hours=h)).hour) for h in range(1, 49)]


def test_step_ahead_has_every_hour(spark):
    df, rows = _series(spark, 24 * 9, skip=(190, 191, 200))
    got = md.step_ahead(df, ["StationID"], "ObservationTime", "Temperature", last=168).orderBy("target_time").collect()
    times = [r[1] for r in rows]
    assert [r["target_time"] for r in got] == times[-168:]
    assert all(r["lag_0"] is not None for r in got) and got[-1]["h"] == 1
    assert {r["h"] for r in got} == {1, 2, 3}


def test_fits_are_bounded(spark):
    rows = spark.range(5000).withColumn("x", F.col("id") * 2)
    assert md.bounded_rows(rows, 10_000).count() == 5000
    assert 300 < md.bounded_rows(rows, 500).count() < 700


def test_bounded_rows_plan_does_not_grow_with_renamed_columns(spark):
    """A hash of many renamed columns as a filter: planning took 2 to their number, and only where rows were too many."""
    import time

    from hourcast.session import cut_lineage
    base = spark.range(300).select(*[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(24)])
    rows = cut_lineage(base).select(*[F.coalesce(F.col(f"c{i}").cast("double"), F.lit(0.0)).alias(f"f{i}") for i in range(24)])
    t0 = time.time()
    kept = cut_lineage(md.bounded_rows(rows, 100))
    assert 50 <= kept.count() <= 200 and time.time() - t0 < 30
    assert {r.f0 for r in kept.collect()} <= {float(i) for i in range(300)}


def test_fit_rows_are_in_few_partitions(spark):
    """A fit runs a task for each partition in every of its stages: their number is bounded, whatever the rows were chosen from."""
    rows = spark.range(5000, numPartitions=50).select("id", (F.col("id") % 7).alias("k"))
    kept = md.fit_rows(md.bounded_rows(rows, 10_000))
    assert kept.rdd.getNumPartitions() <= md.FIT_TASKS
    assert sorted(r["id"] for r in kept.collect()) == list(range(5000))


def test_hourly_series_is_made_once(spark):
    """Anchors, labels and forecasts read the kept series, not the events again."""
    h, anchors, _ = qm._anchors(spark, SF_SMALL)
    steps = md.labelled_steps(md.bounded_anchors(anchors), h, qm.KEYS, qm.T, "Temperature")
    assert not h.inputFiles() and not steps.inputFiles()
