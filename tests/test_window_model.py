"""Forecast by summed normal equations against numpy on the same windows."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.operators import window_model as wm

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "StationID string, ObservationTime timestamp_ntz, Temperature double"


def series(spark, stations=2, n=200, gap=None, seed=0):
    rng = np.random.default_rng(seed)
    out = {}
    for s in range(stations):
        v = 10 + 5 * np.sin(np.arange(n) * 2 * np.pi / 24 + s) + rng.normal(size=n)
        out[str(s)] = v
    rows = [(s, T0 + dt.timedelta(hours=i), None if i == gap else float(x)) for s, v in out.items() for i, x in enumerate(v)]
    return out, spark.createDataFrame(rows, SCHEMA).repartition(3)


def direct(values, seq_len, horizon, ridge, gap=None):
    xs, ys = [], []
    for v in values.values():
        for i in range(len(v) - seq_len - horizon + 1):
            if gap is None or not i <= gap < i + seq_len + horizon:
                xs.append(v[i:i + seq_len])
                ys.append(v[i + seq_len:i + seq_len + horizon])
    x, y = np.array(xs), np.array(ys)
    xc, yc = x - x.mean(0), y - y.mean(0)
    cov = xc.T @ xc / len(x)
    w = np.linalg.solve(cov + ridge * np.trace(cov) / seq_len * np.eye(seq_len), xc.T @ yc / len(x))
    return w, y.mean(0) - x.mean(0) @ w, len(x)


@pytest.mark.parametrize("seq_len,horizon,ridge", [(30, 12, 0.1), (5, 3, 0.0)])
def test_weights_and_forecast(spark, seq_len, horizon, ridge):
    values, df = series(spark)
    model = wm.fit(wm.training_samples(df, ["StationID"], "ObservationTime", "Temperature", seq_len, horizon), seq_len, horizon, ridge)
    w, a, n = direct(values, seq_len, horizon, ridge)
    assert model.samples == n and np.allclose(model.weights, w) and np.allclose(model.intercept, a)
    got = {(r.StationID, r.h): r for r in wm.forecast(df, ["StationID"], "ObservationTime", "Temperature", seq_len, horizon, ridge).collect()}
    assert len(got) == 2 * horizon
    for s, v in values.items():
        want = v[-seq_len:] @ w + a
        assert all(got[s, h + 1].prediction == pytest.approx(want[h]) for h in range(horizon))
        assert got[s, horizon].target_time == T0 + dt.timedelta(hours=199 + horizon)


def test_gaps_and_short_series(spark):
    values, df = series(spark, stations=1, n=120, gap=40)
    model = wm.fit(wm.training_samples(df, ["StationID"], "ObservationTime", "Temperature", 6, 2), 6, 2, 0.1)
    w, a, n = direct(values, 6, 2, 0.1, gap=40)
    assert model.samples == n and np.allclose(model.weights, w)
    short = spark.createDataFrame([("s", T0 + dt.timedelta(hours=i), 1.0 * i) for i in range(4)], SCHEMA)
    assert wm.predict(model, wm.last_windows(short, ["StationID"], "ObservationTime", "Temperature", 6)).count() == 0
    holed = df.where(F.col("ObservationTime") <= F.lit("2024-01-02 17:00:00").cast("timestamp_ntz"))
    assert [r.prediction for r in wm.predict(model, wm.last_windows(holed, ["StationID"], "ObservationTime", "Temperature", 6)).collect()] == [None, None]
    with pytest.raises(ValueError):
        wm.forecast(short, ["StationID"], "ObservationTime", "Temperature", 6, 2)


def test_backtest_pairs_rows_with_labels(spark):
    values, df = series(spark, n=150)
    got = wm.backtest(df, ["StationID"], "ObservationTime", "Temperature", 24, 10, 0.1).collect()
    w, a, _ = direct({s: v[:-10] for s, v in values.items()}, 24, 10, 0.1)
    assert len(got) == 20
    for r in got:
        v = values[r.StationID]
        assert r.label == pytest.approx(v[140 + r.h - 1]) and r.prediction == pytest.approx(v[116:140] @ w[:, r.h - 1] + a[r.h - 1])
