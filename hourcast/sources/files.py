"""Snapshot, split, forecast and result sinks; newest-forecast and CSV sources."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.functions import timefeat as tf

SNAPSHOT_TIME_FORMAT = "yyyy.MM.dd_HHmm"
RUN_STAMP_FORMAT = "%Y%m%d_%H%M"


def snapshot_name(df: DataFrame, time_col: str = "ObservationTime") -> DataFrame:
    """One-row frame with min / max time and the snapshot folder name ``min_max``."""
    return df.agg(F.min(time_col).alias("min_time"), F.max(time_col).alias("max_time")).withColumn(
        "snapshot", F.concat_ws("_", F.date_format("min_time", SNAPSHOT_TIME_FORMAT),
                                F.date_format("max_time", SNAPSHOT_TIME_FORMAT)))


def write_snapshot(df: DataFrame, root: str, version: str = "v1_0_0", time_col: str = "ObservationTime") -> str:
    """Write ``df`` under ``root/version/<min>_<max>`` (a folder of parquet parts)."""
    name = snapshot_name(df, time_col).first()["snapshot"]
    path = os.path.join(root, version, f"{name}")
    df.write.mode("overwrite").parquet(path)
    return path


def write_splits(splits: dict[str, DataFrame], root: str, run_ts: str | None = None) -> str:
    """Write train / val / latest (or test) under ``root/run_ts=.../split=...``."""
    run_ts = run_ts or dt.datetime.now().strftime(RUN_STAMP_FORMAT)
    for name, df in splits.items():
        df.write.mode("overwrite").parquet(os.path.join(root, f"run_ts={run_ts}", f"split={name}"))
    return os.path.join(root, f"run_ts={run_ts}")


def write_forecast(fc: DataFrame, root: str, run_ts: str | None = None) -> str:
    """Write a forecast (or inference result) run-stamped under ``root/run_ts=...``."""
    run_ts = run_ts or dt.datetime.now().strftime(RUN_STAMP_FORMAT)
    path = os.path.join(root, f"run_ts={run_ts}")
    fc.write.mode("overwrite").parquet(path)
    return path


def latest_forecast(spark: SparkSession, root: str, by: str = "run") -> DataFrame:
    """Rows of the newest forecast run, with ``datetime`` and ``date``, sorted by time.

    ``by='run'`` picks the greatest ``run_ts`` partition; ``by='mtime'`` the run that holds the
    newest file by modification time. Either way all files of that run are read: its name comes to
    the driver and prunes the scan as a literal partition filter. A root without runs is one run.
    Raises KeyError when ``pred_Temperature`` is missing.
    """
    df = spark.read.parquet(root)
    if "pred_Temperature" not in df.columns:
        raise KeyError("forecast has no 'pred_Temperature' column")
    if "run_ts" in df.columns:
        if by == "mtime":
            run = F.max_by("run_ts", F.struct(F.col("_metadata.file_modification_time"), F.col("run_ts")))
        else:
            run = F.max("run_ts")
        df = df.filter(F.col("run_ts").eqNullSafe(F.lit(df.select(run.alias("r")).first()["r"])))
    dt_col = tf.from_parts("year", "month", "day", "hour")
    return (df.withColumn("datetime", dt_col).withColumn("date", F.to_date("datetime"))
            .orderBy("datetime"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header (a UTF-8 byte-order mark is dropped by the reader)."""
    r = spark.read.option("header", "true").option("encoding", "UTF-8")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "false")
    return r.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_csv_lake(df: DataFrame, root: str, parts=("year", "month", "day", "hour")) -> None:
    """One folder of CSV per hour, ``year=/month=/day=/hour=``; rows are exchanged by folder first."""
    df.repartition(*parts).write.mode("overwrite").option("header", "true").partitionBy(*parts).csv(root)


def read_csv_lake(spark: SparkSession, root: str, schema: T.StructType, parts=("year", "month", "day", "hour")) -> DataFrame:
    """The whole lake with its partition columns; filters on these prune folders."""
    full = T.StructType([*schema.fields, *[T.StructField(p, T.IntegerType()) for p in parts]])
    return read_csv(spark, root, full)


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """Parquet write then read (column names may be non-ASCII)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
