"""Wave 7 queries: seasonal-naive forecast and its RMSE (full oracles); tree models, the 168-hour
forecast, model ranking and batch inference with advice (rows-only: model fits)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hourcast.functions import advice as adv
from hourcast.operators import models as md
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import register, sql_norm
from hourcast.session import cut_lineage, path_exists
from hourcast.session_paths import scratch, state_tag, tag
from hourcast.sources import files

HOURLY = ad.with_ctes("obs_hourly")
KEYS = ["StationID"]
T = "ObservationTime"

NAIVE_SQL = """
o AS (SELECT StationID, max(ObservationTime) - INTERVAL 168 HOUR AS origin FROM obs_hourly GROUP BY 1),
steps AS (SELECT StationID, origin, h, origin + h * INTERVAL 1 HOUR AS target_time,
                 origin + h * INTERVAL 1 HOUR - (24 * CAST(ceil(h / 24.0) AS BIGINT)) * INTERVAL 1 HOUR AS src
          FROM o, range(1, 169) r(h)),
pred AS (SELECT s.StationID, s.origin, s.h, s.target_time, x.Temperature AS prediction
         FROM steps s LEFT JOIN obs_hourly x ON x.StationID = s.StationID AND x.ObservationTime = s.src)"""


@register("seasonal_naive", oracle=sql_norm(
    "SELECT StationID, origin AS ObservationTime, h, target_time, prediction FROM pred",
    doubles=["prediction"], ints=["h"], ts=["ObservationTime", "target_time"], with_=HOURLY + "," + NAIVE_SQL))
def q_seasonal_naive(spark, sf_dir):
    """Baseline forecast of the last 168 hours of each series from the origin before them."""
    h = ad.obs_hourly(spark, sf_dir)
    origin = md.backtest_origin(h, KEYS, T)
    return md.seasonal_naive(h, KEYS, T, "Temperature", origin).select(KEYS[0], T, "h", "target_time", "prediction")


@register("rmse", oracle=sql_norm("""
SELECT p.StationID, sqrt(avg((a.Temperature - p.prediction) * (a.Temperature - p.prediction))) AS "RMSE", count(*) AS n
FROM pred p JOIN obs_hourly a ON a.StationID = p.StationID AND a.ObservationTime = p.target_time
WHERE p.prediction IS NOT NULL GROUP BY 1""", doubles=["RMSE"], ints=["n"], with_=HOURLY + "," + NAIVE_SQL))
def q_rmse(spark, sf_dir):
    """RMSE of the seasonal-naive backtest per series (cells with both values)."""
    h = ad.obs_hourly(spark, sf_dir)
    origin = md.backtest_origin(h, KEYS, T)
    p = md.with_actuals(md.seasonal_naive(h, KEYS, T, "Temperature", origin), h, KEYS, T, "Temperature")
    p = p.filter(F.col("prediction").isNotNull())
    d = F.col("label") - F.col("prediction")
    return p.groupBy(*KEYS).agg(F.sqrt(F.avg(d * d)).alias("RMSE"), F.count(F.lit(1)).alias("n"))


def _anchors(spark, sf_dir):
    """The hourly series (kept: anchors, labels and forecasts read it), its anchors with their lags, and the last week's beginning."""
    h = cut_lineage(ad.obs_hourly(spark, sf_dir).select(*KEYS, T, "Temperature"))
    cut = h.agg(F.max(T)).first()[0] - dt.timedelta(hours=md.HORIZON)
    return h, cut_lineage(md.anchor_features(h, KEYS, T, "Temperature").dropna()), cut


def _fit_rows(rows):
    """What a fit reads of (anchor, step) rows: the features and the label of all of them, kept."""
    return md.fit_rows(rows.select(*md.feature_columns(), "label"))


def _rows(spark, sf_dir):
    """(anchor, step 1..168) rows of every anchor cut by target time at the last week: all before it for the fit, all after it for validation."""
    h, anchors, cut = _anchors(spark, sf_dir)
    near = anchors.filter(F.col(T) > F.lit((cut - dt.timedelta(hours=md.HORIZON)).isoformat(sep=" ")).cast("timestamp_ntz"))
    train, _ = md.before_and_after(md.labelled_steps(anchors, h, KEYS, T, "Temperature"), cut)
    _, val = md.before_and_after(md.labelled_steps(near, h, KEYS, T, "Temperature"), cut)
    return h, _fit_rows(train), cut_lineage(val)  # iterative fits and four models read these many times


def _report(spark, sf_dir):
    """The model report of ``sf_dir``: fitted and scored once per application and state of the input's files, kept as CSV in the shared scratch folder."""
    schema = "Model string, RMSE double, Training_Time double, n_scored long"
    path = scratch(spark, "model_report", state_tag(spark, sf_dir, "events"))
    if not path_exists(spark, path + "/_SUCCESS"):
        _, train, val = _rows(spark, sf_dir)
        fitted = md.fit_models(train, md.feature_columns(), md.regressors())
        report = md.evaluate_models(fitted, val).withColumn("n_scored", F.lit(val.count()))
        files.write_csv(report, path)
    return spark.read.option("header", "true").schema(schema).csv(path)


@register("tree_models", note="model fits; rows-only")
def q_tree_models(spark, sf_dir):
    """M6 + M9: fit linear / tree / forest / boosted regressors (100 estimators, 168 steps, every anchor), score RMSE
    on every row whose target lies in the held-out last week, rank. Fits use every row whose target lies before it."""
    return _report(spark, sf_dir)


@register("tree_models_scored", oracle=sql_norm("""
WITH cut AS (SELECT max(ObservationTime) - INTERVAL 168 HOUR AS c FROM obs_hourly),
p AS (SELECT StationID, ObservationTime, row_number() OVER (PARTITION BY StationID ORDER BY ObservationTime) AS pos FROM obs_hourly),
n AS (SELECT count(*) AS n_scored FROM p JOIN obs_hourly t ON t.StationID = p.StationID AND t.ObservationTime > p.ObservationTime
        AND t.ObservationTime <= p.ObservationTime + INTERVAL 168 HOUR, cut WHERE p.pos > 23 AND t.ObservationTime > cut.c)
SELECT m AS Model, n_scored, true AS better_than_spread FROM n, (VALUES ('LinearRegression'), ('DecisionTree'), ('RandomForest'), ('GBT')) v(m)"""
    .replace("WITH cut AS", "SELECT * FROM (WITH cut AS", 1) + ")", ints=["n_scored"], with_=HOURLY))
def q_tree_models_scored(spark, sf_dir):
    """M9: every model is scored on every validation row, and none is worse than twice the target's spread."""
    spread = ad.obs_hourly(spark, sf_dir).agg(F.stddev_pop("Temperature")).first()[0]
    return _report(spark, sf_dir).select("Model", "n_scored", (F.col("RMSE") < 2 * spread).alias("better_than_spread"))


@register("top_models", note="model fits; rows-only")
def q_top_models(spark, sf_dir):
    """O3 / M9: the three best models by RMSE, from the same report."""
    return md.top_models(_report(spark, sf_dir), 3)


def _forecast(spark, sf_dir):
    root = scratch(spark, "forecast168", state_tag(spark, sf_dir, "events"))
    if not path_exists(spark, f"{root}/run_ts=20240131_0000/_SUCCESS"):
        h, anchors, _ = _anchors(spark, sf_dir)
        rows = _fit_rows(md.labelled_steps(anchors, h, KEYS, T, "Temperature"))
        model = md.fit_models(rows, md.feature_columns(), {"rf": md.regressors()["RandomForest"]})["rf"][0]
        files.write_forecast(md.forecast(model, h, KEYS, T, "Temperature", md.HORIZON), root, "20240131_0000")
    return files.latest_forecast(spark, root).drop("run_ts")


@register("forecast_168", note="model fit; rows-only")
def q_forecast_168(spark, sf_dir):
    """M8 + S12: 168-hour forecast per series from its last observation with a random forest of 100 trees,
    written run-stamped and read back as the newest run."""
    return _forecast(spark, sf_dir)


@register("forecast_168_times", oracle=sql_norm("""
SELECT StationID, h, CAST(year(t) AS BIGINT) AS year, CAST(month(t) AS BIGINT) AS month, CAST(day(t) AS BIGINT) AS day,
       CAST(hour(t) AS BIGINT) AS hour, dayname(t) AS day_of_week, true AS in_range, true AS one_digit
FROM (SELECT StationID, h, last + h * INTERVAL 1 HOUR AS t FROM (SELECT StationID, max(ObservationTime) AS last FROM obs_hourly GROUP BY 1), range(1, 169) r(h))""",
    ints=["h"], with_=HOURLY))
def q_forecast_168_times(spark, sf_dir):
    """M8: the forecast's keys and times, its values within the observed range, rounded to one digit."""
    lo, hi = ad.obs_hourly(spark, sf_dir).agg(F.min("Temperature"), F.max("Temperature")).first()
    p = F.col("pred_Temperature").cast("double")
    return _forecast(spark, sf_dir).select(*KEYS, "h", "year", "month", "day", "hour", "day_of_week", p.between(lo - 0.05, hi + 0.05).alias("in_range"),
                                           (F.abs(p * 10 - F.rint(p * 10)) < 1e-3).alias("one_digit"))


def _inference(spark, sf_dir):
    h, anchors, cut = _anchors(spark, sf_dir)
    near, _ = md.before_and_after(md.labelled_steps(anchors, h, KEYS, T, "Temperature", 3), cut)
    model = md.fit_models(_fit_rows(near), md.feature_columns(), {"lr": md.regressors()["LinearRegression"]})["lr"][0]
    p = model.transform(md.step_ahead(h, KEYS, T, "Temperature", md.HORIZON))
    t = F.col("target_time")
    out = p.select(*KEYS, F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"),
                   F.hour(t).alias("hour"), F.col("prediction").alias("pred_temp"),
                   adv.clothing_sentence(F.col("prediction"), F.lit("normal")).alias("cloth_rec"))
    return files.round_trip(out, scratch(spark, "inference", tag(sf_dir)))


@register("batch_inference", note="model fit; rows-only")
def q_batch_inference(spark, sf_dir):
    """M7 + P14 + S16: predict each of the last 168 hours of every series with a linear model, add the clothing
    sentence, keep (year, month, day, hour, pred_temp, cloth_rec) and write the result."""
    return _inference(spark, sf_dir)


@register("batch_inference_keys", oracle=sql_norm("""
SELECT StationID, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(day AS BIGINT) AS day, CAST(hour AS BIGINT) AS hour, true AS advised
FROM (SELECT *, row_number() OVER (PARTITION BY StationID ORDER BY ObservationTime DESC) AS r FROM obs_hourly) WHERE r <= 168""", with_=HOURLY))
def q_batch_inference_keys(spark, sf_dir):
    """M7: one row for each of the last 168 hours, its sentence showing the predicted temperature."""
    shown = F.regexp_extract("cloth_rec", "(-?[0-9]+\\.[0-9])", 1).cast("double")
    return _inference(spark, sf_dir).select(*KEYS, "year", "month", "day", "hour", F.coalesce(F.abs(shown - F.col("pred_temp")) <= 0.0500001, F.lit(False)).alias("advised"))
