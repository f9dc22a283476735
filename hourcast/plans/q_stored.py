"""Stored models and fitted state, and forecasts by normal equations: closed forms, so the oracles check all values."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hourcast.operators import models as md
from hourcast.operators import registry, stored_state
from hourcast.operators import window_model as wm
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import register, sql_norm
from hourcast.session import cut_lineage
from hourcast.session_paths import scratch

HOURLY = ad.with_ctes("obs_hourly")
KEYS = ["StationID"]
T = "ObservationTime"

LAG_ROWS_SQL = """
p AS (SELECT StationID, ObservationTime, Temperature AS lag_0, lag(Temperature, 23) OVER (PARTITION BY StationID ORDER BY ObservationTime) AS lag_23 FROM obs_hourly),
r AS (SELECT p.*, t.ObservationTime AS target_time, t.Temperature AS label FROM p JOIN obs_hourly t
        ON t.StationID = p.StationID AND t.ObservationTime = p.ObservationTime + INTERVAL 1 HOUR WHERE lag_23 IS NOT NULL),
cut AS (SELECT max(ObservationTime) - INTERVAL 168 HOUR AS c FROM obs_hourly),
fit AS (SELECT 'Linear_lag_0' AS Model, regr_slope(label, lag_0) AS b, regr_intercept(label, lag_0) AS a FROM r, cut WHERE target_time <= c
        UNION ALL SELECT 'Linear_lag_23', regr_slope(label, lag_23), regr_intercept(label, lag_23) FROM r, cut WHERE target_time <= c),
scored AS (SELECT Model, StationID, target_time, label, a + b * CASE Model WHEN 'Linear_lag_0' THEN lag_0 ELSE lag_23 END AS prediction
           FROM r, cut, fit WHERE target_time > c),
report AS (SELECT Model, sqrt(avg((label - prediction) * (label - prediction))) AS "RMSE", count(*) AS n FROM scored GROUP BY 1)"""


def _lag_rows(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir).select(*KEYS, T, "Temperature")
    cut = h.agg(F.max(T)).first()[0] - dt.timedelta(hours=md.HORIZON)
    return md.before_and_after(cut_lineage(md.training_rows(h, KEYS, T, "Temperature", 1, lags=(0, 23))), cut)


def _logged(spark, sf_dir):
    """Two linear models with one lag each, fitted, scored and stored; returns the folder and the validation rows."""
    root = scratch(spark, "registry", uuid.uuid4().hex[:12])
    train, val = _lag_rows(spark, sf_dir)
    for lag in ("lag_0", "lag_23"):
        registry.train_and_log(train, val, [lag], {"Linear": LinearRegression(featuresCol="features", labelCol="label")}, root, f"_{lag}")
    return root, val


@register("model_registry", oracle=sql_norm("""
SELECT Model, StationID, target_time, label, prediction FROM scored WHERE Model = (SELECT arg_min(Model, "RMSE") FROM report)""",
    doubles=["label", "prediction"], ts=["target_time"], with_=HOURLY + "," + LAG_ROWS_SQL))
def q_model_registry(spark, sf_dir):
    """M9: the run with the lowest RMSE is looked up, promoted, loaded from its folder, and predicts the validation rows."""
    root, val = _logged(spark, sf_dir)
    best = registry.best_run(spark, root)
    registry.promote(spark, root, best, "temperature")
    model = registry.production_model(spark, root, "temperature")
    return model.transform(val).select(F.lit(best["name"]).alias("Model"), *KEYS, "target_time", "label", "prediction")


@register("model_runs", oracle=sql_norm("""
SELECT Model, "RMSE", n, row_number() OVER (ORDER BY "RMSE") AS place FROM report""", doubles=["RMSE"], ints=["n", "place"], with_=HOURLY + "," + LAG_ROWS_SQL))
def q_model_runs(spark, sf_dir):
    """M9 + A18 + O3: the run table's order, and each name's stored model scored again on all validation rows."""
    root, val = _logged(spark, sf_dir)
    names = [r["name"] for r in registry.runs(spark, root).collect()]
    place = spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "Model string, place long")
    return registry.evaluate_runs(spark, root, names, val).join(F.broadcast(place), "Model")  # one row for each run


@register("boosted_with_stop", oracle=sql_norm("""
SELECT count(*) AS n, true AS stopped, true AS better_than_spread FROM r, cut WHERE target_time > c""", ints=["n"], with_=HOURLY + "," + LAG_ROWS_SQL))
def q_boosted_with_stop(spark, sf_dir):
    """M6: boosting of at most 100 trees that the validation rows stop; scored on every one of them."""
    train, val = _lag_rows(spark, sf_dir)
    features = ["lag_0", "lag_23", "target_hour_sin", "target_hour_cos"]
    model = md.boosted_with_stop(md.fit_rows(train), md.fit_rows(val), features)
    spread = train.agg(F.stddev_pop("label")).first()[0]
    score = md.rmse(model.transform(val))
    return score.select("n", F.lit(model.stages[-1].getNumTrees < 100).alias("stopped"), (F.col("RMSE") < 2 * spread).alias("better_than_spread"))


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("encode_stored", oracle=sql_norm(f"""
WITH fit AS (SELECT * FROM part WHERE p_size <= 10),
q AS (SELECT quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.5) AS q2, quantile_cont(p_retailprice, 0.75) AS q3 FROM fit),
classes AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT p_brand AS label FROM fit UNION SELECT 'unseen'))
SELECT p_partkey, (p_retailprice - q2) / CASE WHEN q3 = q1 THEN 1.0 ELSE q3 - q1 END AS p_retailprice,
  coalesce(c.idx, (SELECT idx FROM classes WHERE label = 'unseen')) AS p_brand,
  {", ".join(f'''CASE WHEN p_type = '{v}' THEN 1 ELSE 0 END AS "p_type_{v}"''' for v in TYPES)}, CAST(1 AS BIGINT) AS version
FROM part CROSS JOIN q LEFT JOIN classes c ON c.label = p_brand WHERE p_size > 10""",
    doubles=["p_retailprice"], ints=["p_partkey", "p_brand", *[f"p_type_{v}" for v in TYPES]]))
def q_encode_stored(spark, sf_dir):
    """M4 + M5 in inference mode: one job fits on parts of size <= 10 and stores the state, another one prepares the other
    parts from the stored state alone (an extra column is dropped, the layout is the training one)."""
    root = scratch(spark, "state", uuid.uuid4().hex[:12])
    parts = ad.read(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_brand", "p_type", "p_size")
    state, _ = stored_state.fit(parts.filter("p_size <= 10").drop("p_size"), ["p_retailprice"], ["p_brand", "p_type"], unseen_token=True, one_hot_type="int")
    stored_state.save(state, root)
    known = stored_state.load(spark, root)
    return stored_state.apply(parts.filter("p_size > 10"), known).withColumn("version", F.lit(known.version))


@register("window_forecast", oracle=sql_norm("""
SELECT StationID, h, last + h * INTERVAL 1 HOUR AS target_time, true AS in_range
FROM (SELECT StationID, max(ObservationTime) AS last FROM obs_hourly GROUP BY 1 HAVING count(*) >= 336), range(1, 169) r(h)""",
    ints=["h"], ts=["target_time"], with_=HOURLY))
def q_window_forecast(spark, sf_dir):
    """M8: 168 hours from the last 336 rows of each station by one least-squares solve over all windows."""
    h = cut_lineage(ad.obs_hourly(spark, sf_dir).select(*KEYS, T, "Temperature"))
    lo, hi = h.agg(F.min("Temperature"), F.max("Temperature")).first()
    p = wm.forecast(h, KEYS, T, "Temperature")
    return p.select(*KEYS, "h", "target_time", F.coalesce(F.col("prediction").between(lo, hi), F.lit(False)).alias("in_range"))


@register("window_forecast_values", oracle=sql_norm("""
SELECT StationID, h, last + h * INTERVAL 1 HOUR AS target_time, a + b1 * x1 + b2 * x2 AS prediction FROM (
  SELECT h, b1, b2, my - b1 * m1 - b2 * m2 AS a FROM (
    SELECT h, m1, m2, my, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM (
      SELECT h, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12,
             covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM (
        SELECT x1, x2, 1 AS h, y1 AS y FROM s WHERE y2 IS NOT NULL UNION ALL SELECT x1, x2, 2, y2 FROM s WHERE y2 IS NOT NULL) GROUP BY h))), (
  SELECT StationID, max(ObservationTime) AS last, arg_max(Temperature, ObservationTime) AS x2, arg_max(before, ObservationTime) AS x1 FROM (
    SELECT *, lag(Temperature) OVER (PARTITION BY StationID ORDER BY ObservationTime) AS before FROM obs_hourly) GROUP BY 1)""",
    doubles=["prediction"], ints=["h"], ts=["target_time"], with_=HOURLY + """,
s AS (SELECT Temperature AS x1, lead(Temperature) OVER w AS x2, lead(Temperature, 2) OVER w AS y1, lead(Temperature, 3) OVER w AS y2
      FROM obs_hourly WINDOW w AS (PARTITION BY StationID ORDER BY ObservationTime))"""))
def q_window_forecast_values(spark, sf_dir):
    """M8 with two values in and two steps out, no penalty: the same solve, whose values SQL gives in closed form."""
    h = ad.obs_hourly(spark, sf_dir).select(*KEYS, T, "Temperature")
    return wm.forecast(h, KEYS, T, "Temperature", 2, 2, ridge=0.0).select(*KEYS, "h", "target_time", "prediction")


@register("window_backtest", oracle=sql_norm("""
SELECT (SELECT sum(least(n, 168)) FROM (SELECT count(*) AS n FROM obs_hourly GROUP BY StationID) WHERE n >= 504) AS n, true AS not_above_naive""",
    ints=["n"], with_=HOURLY))
def q_window_backtest(spark, sf_dir):
    """M8: the forecast of every station's last 168 rows from those before has no higher RMSE than the seasonal-naive one."""
    h = cut_lineage(ad.obs_hourly(spark, sf_dir).select(*KEYS, T, "Temperature"))
    naive = md.with_actuals(md.seasonal_naive(h, KEYS, T, "Temperature", md.backtest_origin(h, KEYS, T)), h, KEYS, T, "Temperature")
    limit = md.rmse(naive.where("prediction is not null")).first()["RMSE"]
    score = md.rmse(wm.backtest(h, KEYS, T, "Temperature"))
    return score.select("n", (F.col("RMSE") <= limit).alias("not_above_naive"))
