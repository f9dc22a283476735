"""Fitted scaler and encoder state as versioned tables (M4 and M5 in inference mode).

A training job fits the state and writes ``root/version=N/{scaler,encoders,layout}``; a later job reads it and prepares
new rows from it alone. ``layout`` (the feature columns in order) is written last and makes the version complete:
readers look for its ``_SUCCESS`` only. All tables have one row for each column or category.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators import clean, encode
from hourcast.session import cut_lineage, path_exists

SCALER = "column string, median double, scale double"
ENCODERS = "column string, kind string, label string, idx long"
LAYOUT = "position int, column string, unseen_token boolean, one_hot_type string"


@dataclass
class State:
    scaler: DataFrame
    encoders: DataFrame
    columns: list[str]
    unseen_token: bool
    one_hot_type: str
    version: int | None = None


def _scaled_and_encoded(df: DataFrame, s: State) -> DataFrame:
    return encode.apply_encoders(encode.apply_robust_scaler(df, s.scaler), s.encoders, s.unseen_token, s.one_hot_type)


def fit(train: DataFrame, numeric, categorical, unseen_token: bool = False, one_hot_type: str = "double") -> tuple[State, DataFrame]:
    """The state of ``train`` and its prepared rows. Columns that are neither numeric nor categorical pass through."""
    scaler = cut_lineage(encode.fit_robust_scaler(train, list(numeric)))
    encoders = cut_lineage(encode.fit_encoders(train, list(categorical), unseen_token=unseen_token))
    state = State(scaler, encoders, [], unseen_token, one_hot_type)
    prepared = _scaled_and_encoded(train, state)
    state.columns = prepared.columns
    return state, prepared


def complete_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose last table is whole, newest first."""
    if not path_exists(spark, root):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    names = [f.getPath().getName() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    found = sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True)
    return [v for v in found if path_exists(spark, f"{root}/version={v}/layout/_SUCCESS")]


def save(state: State, root: str) -> int:
    """Write ``state`` as the next version; returns its number. A number whose write was cut short is written over."""
    spark = state.scaler.sparkSession
    done = complete_versions(spark, root)
    version = (done[0] if done else 0) + 1
    base = f"{root}/version={version}"
    state.scaler.coalesce(1).write.mode("overwrite").parquet(f"{base}/scaler")
    state.encoders.write.mode("overwrite").parquet(f"{base}/encoders")
    rows = [(i, c, state.unseen_token, state.one_hot_type) for i, c in enumerate(state.columns)]
    spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{base}/layout")
    state.version = version
    return version


def load(spark: SparkSession, root: str, version: int | None = None) -> State:
    """A stored state (the newest complete one); raises LookupError when there is none."""
    done = complete_versions(spark, root)
    if version is None:
        version = done[0] if done else None
    if version not in done:
        raise LookupError(f"no complete version {'' if version is None else version} under {root}")
    base = f"{root}/version={version}"
    layout = spark.read.schema(LAYOUT).parquet(f"{base}/layout").orderBy("position").collect()  # one row for each column
    return State(spark.read.schema(SCALER).parquet(f"{base}/scaler"), spark.read.schema(ENCODERS).parquet(f"{base}/encoders"),
                 [r["column"] for r in layout], layout[0]["unseen_token"], layout[0]["one_hot_type"], version)


def apply(df: DataFrame, state: State) -> DataFrame:
    """New rows in the training layout: scaled and encoded from ``state`` alone, missing columns 0, others dropped.

    A category that training has not seen is all zeros (one-hot), -1, or the index of 'unseen'.
    """
    return clean.align_features(_scaled_and_encoded(df, state), state.columns)


def categories(state: State) -> DataFrame:
    """What each encoded column became: (column, kind, n)."""
    return state.encoders.groupBy("column", "kind").agg(F.count(F.lit(1)).alias("n"))
