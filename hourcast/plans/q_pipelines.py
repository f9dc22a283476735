"""End-to-end chains of the reference as queries (hourly load, training preparation, day advice)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hourcast.functions import advice as adv
from hourcast.operators import models as md
from hourcast.plans import adapters as ad
from hourcast.plans import pipelines as pl
from hourcast.plans.catalog import printed, register, sql_norm
from hourcast.plans.q_advice import dim_values_sql
from hourcast.session import path_exists
from hourcast.session_paths import scratch, state_tag
from hourcast.sources import files, text

WIDE = ad.with_ctes("obs_wide")


@register("pipeline_hourly_load", oracle=sql_norm("""
SELECT year, month, day, count(DISTINCT (StationID, date_trunc('minute', ObservationTime))) AS n_rows FROM obs_wide GROUP BY 1, 2, 3""",
    ints=["year", "month", "day", "n_rows"], with_=WIDE))
def q_pipeline_hourly_load(spark, sf_dir):
    """Entry 1: two text deliveries (days 1-20, then everything) parsed and merged into the lake;
    one row per (station, minute) survives, as the text has minute resolution."""
    base = scratch(spark, "hourly_load", uuid.uuid4().hex[:12])
    obs = ad.obs_wide(spark, sf_dir)
    text.render_observation_lines(obs.filter(F.col("day") <= 20)).write.text(base + "/landing1")
    text.render_observation_lines(obs).write.text(base + "/landing2")
    pl.hourly_load(spark, base + "/landing1", base + "/lake")
    pl.hourly_load(spark, base + "/landing2", base + "/lake", overlap_hours=6)
    d = spark.read.parquet(base + "/lake")
    return d.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


@register("pipeline_training", oracle=sql_norm("SELECT StationID, count(*) - 2 * 503 - 1 AS n_samples FROM obs_wide GROUP BY 1",
                                               ints=["n_samples"], with_=WIDE))
def q_pipeline_training(spark, sf_dir):
    """Entry 2 on the raw observations (L=336, H=168): clean, select, derive, split, scale, encode, sample; samples per
    station. A station's train frame lacks its last 504 rows, and 503 rows start no sample."""
    obs = ad.obs_wide(spark, sf_dir).drop("event_id")
    return pl.sample_count(pl.training_data(obs)["samples"])


def _scored(spark, sf_dir):
    """Predictions of the chain's best model: made once per application and state of the input's files, kept in the shared scratch folder."""
    path = scratch(spark, "train_and_score", state_tag(spark, sf_dir, "events"))
    if not path_exists(spark, path + "/_SUCCESS"):
        obs = ad.obs_wide(spark, sf_dir).drop("event_id")
        pl.train_and_score(obs, md.regressors(), high_corr=0.95)[2].write.parquet(path)
    return spark.read.parquet(path)


@register("pipeline_train_and_score", note="model fits on the prepared table; rows-only")
def q_pipeline_train_and_score(spark, sf_dir):
    """Entry 2 to its end: prepared table (with the tree pipeline's |rho| > 0.95 selection) -> linear and tree models ->
    predictions of every validation row by the best of all four."""
    return _scored(spark, sf_dir)


@register("pipeline_train_and_score_keys", oracle=sql_norm("""
SELECT StationID, ObservationTime, label, true AS predicted FROM (
  SELECT StationID, ObservationTime, lead("Temperature") OVER (PARTITION BY StationID ORDER BY ObservationTime) AS label,
         row_number() OVER (PARTITION BY StationID ORDER BY ObservationTime DESC) AS r FROM obs_wide) WHERE r BETWEEN 2 AND 504""",
    doubles=["label"], ts=["ObservationTime"], with_=WIDE))
def q_pipeline_train_and_score_keys(spark, sf_dir):
    """The same run: one prediction and the right label for every validation row that a next row follows."""
    return _scored(spark, sf_dir).select("StationID", "ObservationTime", "label", (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("predicted"))


@register("pipeline_day_advice", oracle=sql_norm(f"""
SELECT a.StationID, a.date, a.band, d.style, d.category, d.item_pos, d.item,
       {printed('a.av', 2)} AS avg_temp, {printed('a.mn', 2)} AS min_temp,
       {printed('a.mx', 2)} AS max_temp, {printed('a.mx - a.mn', 2)} AS temp_difference,
       {adv.activity_case_sql('a.band')} AS activity_tip, {adv.layering_case_sql('(a.mx - a.mn)')} AS layering_tip
FROM (SELECT StationID, date, avg(pred_Temperature) AS av, min(pred_Temperature) AS mn, max(pred_Temperature) AS mx,
             {adv.band_case_sql('avg(pred_Temperature)')} AS band FROM forecast GROUP BY 1, 2) a
JOIN ({dim_values_sql()}) d ON a.band = d.band""",
    doubles=["avg_temp", "min_temp", "max_temp", "temp_difference"], ints=["item_pos"], dates=["date"],
    with_=ad.with_ctes("forecast")))
def q_pipeline_day_advice(spark, sf_dir):
    """Entry 3: write the forecast run-stamped, read the newest run, advise every (station, day)."""
    root = scratch(spark, "day_advice", uuid.uuid4().hex[:12])
    files.write_forecast(ad.forecast(spark, sf_dir), root, "20240131_0000")
    return pl.day_advice(spark, root)
