"""Structured Streaming jobs (ST1, ST2): incremental ingest of landed files and daily summaries.

All run with ``trigger(availableNow=True)`` (process what has landed, then stop) and keep their progress in a
checkpoint location. ``ingest_stream`` and ``daily_summary_stream`` write through ``foreachBatch``, where a
micro-batch that is replayed after a failure writes the same rows again; they need no state, so an observation may
arrive any time after its day. ``ingest_stream`` can remove re-sent rows in state first. ``daily_windows_stream`` keeps
event-time windows in the state store and emits each of them once, when the watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.sources import lake

FILES_PER_TRIGGER = 500  # bounds a micro-batch, however much has landed


def _landed(spark: SparkSession, landing: str, schema: T.StructType, files_per_trigger: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)


def ingest_stream(spark: SparkSession, landing: str, schema: T.StructType, root: str, checkpoint: str,
                  keys=("StationID",), time_col: str = "ObservationTime", files_per_trigger: int = FILES_PER_TRIGGER,
                  drop_resent: str | None = None) -> None:
    """ST1: landed parquet -> merged into the day lake, one row per (keys, time), the later file winning.

    The merge removes duplicates within a batch and against the lake, so late rows of any age land.

    With ``drop_resent`` (an interval such as "7 days") rows that equal, in all columns, one that has landed within that time
    are removed in state before the merge, so a replayed delivery rewrites no day. The watermark follows the time at
    which a batch runs, not the observations, so no late or corrected row is lost; a correction that goes back
    to what was sent before within the interval counts as re-sent. State holds one key for each row of the interval.
    """
    src = _landed(spark, landing, schema, files_per_trigger).select("*", F.col("_metadata.file_modification_time").alias("_arrival"))
    if drop_resent:
        content = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields])
        src = (src.withColumns({"_seen": F.current_timestamp(), "_content": content}).withWatermark("_seen", drop_resent)
               .dropDuplicatesWithinWatermark([*keys, time_col, "_content"]).drop("_seen", "_content"))

    def merge(batch: DataFrame, epoch_id: int) -> None:
        # an empty batch may follow the last one under availableNow: merge_days accepts 0 rows
        batch.persist()
        try:
            lake.merge_days(batch.sparkSession, batch, root, list(keys), time_col, arrival="_arrival")
        finally:
            batch.unpersist()

    q = (src.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def daily_summary_stream(spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str,
                         keys=("StationID",), time_col: str = "ObservationTime", value_col: str = "Temperature",
                         files_per_trigger: int = FILES_PER_TRIGGER) -> None:
    """ST2: per (series, day) count / sum / min / max of ``value_col``, updated as files land.

    Each micro-batch writes its own partial sums under ``out/epoch=N`` (overwritten by a replay) and
    ``read_daily_summary`` adds them up: late rows of any age count, nothing is read back, and no
    state is kept. ``out`` and ``checkpoint`` belong together.
    """
    keys = list(keys)
    src = _landed(spark, landing, schema, files_per_trigger)

    def add(batch: DataFrame, epoch_id: int) -> None:
        (batch.groupBy(*keys, F.to_date(time_col).alias("obs_date"))
         .agg(F.count(F.lit(1)).alias("n"), F.count(value_col).alias("n_values"), F.sum(value_col).alias("sum_value"),
              F.min(value_col).alias("min_value"), F.max(value_col).alias("max_value"))
         .write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}"))

    q = (src.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_daily_summary(spark: SparkSession, out: str, keys=("StationID",)) -> DataFrame:
    return (spark.read.parquet(out).groupBy(*keys, "obs_date")
            .agg(F.sum("n").alias("n"), (F.sum("sum_value") / F.sum("n_values")).alias("mean_value"),
                 F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value")))


def _wall_clock(time_col: str):
    """A wall-clock time as an instant of UTC, whatever the session's zone: windows are then calendar days."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{time_col}` AS TIMESTAMP_NTZ))"))


def daily_windows_stream(spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str, keys=("StationID",),
                         time_col: str = "ObservationTime", value_col: str = "Temperature", lateness: str = "1 day",
                         files_per_trigger: int = FILES_PER_TRIGGER) -> None:
    """ST2 with event time: each (series, day) is a window in state, written once, after its end plus ``lateness``.

    Late rule: a row is counted if its day has not been written when its batch begins; that is, if its day ends after the
    newest observation time of earlier batches less ``lateness``. Later rows are dropped. State holds
    the open days only. Days still open at the end of a run stay in state for the next one.
    """
    day = F.window("_event", "1 day")
    (_landed(spark, landing, schema, files_per_trigger).withColumn("_event", _wall_clock(time_col)).withWatermark("_event", lateness)
     .groupBy(*keys, day.alias("w"))
     .agg(F.count(F.lit(1)).alias("n"), F.avg(value_col).alias("mean_value"), F.min(value_col).alias("min_value"), F.max(value_col).alias("max_value"))
     .select(*keys, F.date_from_unix_date((F.unix_seconds("w.start") / 86400).cast("int")).alias("obs_date"), "n", "mean_value", "min_value", "max_value")
     .writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
