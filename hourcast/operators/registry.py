"""Run table and stored models (M9): what was fitted, how well it scored, and the model itself, looked up by name.

Layout under ``root``: ``models/<name>/<run_id>`` holds a written ``PipelineModel``, ``runs`` one row for each run and
``versions`` one row for each promotion. A run's row is written after its model, and a version's after its run, so
a job that dies in between leaves nothing that a lookup finds. Both tables hold a row for each fit, whatever the data's size.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from hourcast.operators import models as md
from hourcast.session import path_exists

RUNS = "name string, run_id string, params map<string,string>, rmse double, training_time double, path string, logged_at timestamp_ntz"
VERSIONS = "name string, version long, run_name string, run_id string, path string"


def log_run(spark: SparkSession, root: str, name: str, model: PipelineModel, rmse: float, training_time: float = 0.0,
            params: dict | None = None, run_id: str | None = None) -> str:
    """Write ``model`` and its row; returns the run id."""
    run_id = run_id or uuid.uuid4().hex
    path = f"{root}/models/{name}/{run_id}"
    model.write().overwrite().save(path)
    row = [(name, run_id, {k: str(v) for k, v in (params or {}).items()}, float(rmse), float(training_time), path)]
    schema = RUNS.rsplit(", ", 1)[0]
    spark.createDataFrame(row, schema).withColumn("logged_at", F.localtimestamp()).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return run_id


def runs(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """The run table (of one name), best first; empty where nothing was logged."""
    path = f"{root}/runs"
    df = spark.read.schema(RUNS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], RUNS)
    return (df.where(F.col("name") == name) if name is not None else df).orderBy("rmse", "run_id")


def best_run(spark: SparkSession, root: str, name: str | None = None) -> Row:
    """The run with the lowest RMSE (of one name, or of all); NaN scores come last."""
    row = runs(spark, root, name).first()
    if row is None:
        raise LookupError(f"no run{f' named {name}' if name else ''} under {root}")
    return row


def load_model(run: Row) -> PipelineModel:
    return PipelineModel.load(run["path"])


def train_and_log(train: DataFrame, val: DataFrame, features, models: dict, root: str, suffix: str = "") -> DataFrame:
    """Fit every model, score it on all of ``val`` and log it as a run named after it; returns the new rows' table, best first."""
    spark = train.sparkSession
    ids = []
    for name, (model, seconds) in md.fit_models(train, features, models).items():
        rmse = md.rmse(model.transform(val)).first()["RMSE"]
        settings = {p.name: v for p, v in models[name].extractParamMap().items() if p.name in ("maxIter", "numTrees", "maxDepth", "stepSize", "regParam", "seed")}
        ids.append(log_run(spark, root, name + suffix, model, float("nan") if rmse is None else rmse, seconds, settings | {"model_name": name}))
    return runs(spark, root).where(F.col("run_id").isin(ids))


def evaluate_runs(spark: SparkSession, root: str, names, val: DataFrame) -> DataFrame:
    """Each name's best stored model, loaded and scored on ``val`` again: (Model, RMSE, n), best first. Unknown names are left out."""
    known = {r["name"] for r in runs(spark, root).select("name").distinct().collect()}
    out = None
    for name in [n for n in names if n in known]:
        score = md.rmse(load_model(best_run(spark, root, name)).transform(val)).select(F.lit(name).alias("Model"), "RMSE", "n")
        out = score if out is None else out.unionByName(score)
    return (out if out is not None else spark.createDataFrame([], "Model string, RMSE double, n long")).orderBy("RMSE")


def promote(spark: SparkSession, root: str, run: Row, registry_name: str) -> int:
    """Make ``run`` the newest version of ``registry_name``; returns the version."""
    path = f"{root}/versions"
    last = versions(spark, root, registry_name).agg(F.max("version")).first()[0] or 0
    row = [(registry_name, last + 1, run["name"], run["run_id"], run["path"])]
    spark.createDataFrame(row, VERSIONS).coalesce(1).write.mode("append").parquet(path)
    return last + 1


def versions(spark: SparkSession, root: str, registry_name: str) -> DataFrame:
    path = f"{root}/versions"
    df = spark.read.schema(VERSIONS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], VERSIONS)
    return df.where(F.col("name") == registry_name).orderBy(F.desc("version"))


def production_model(spark: SparkSession, root: str, registry_name: str) -> PipelineModel:
    """The newest version of ``registry_name``."""
    row = versions(spark, root, registry_name).first()
    if row is None:
        raise LookupError(f"no version of {registry_name} under {root}")
    return load_model(row)
