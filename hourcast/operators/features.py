"""M3: derived features in one ``withColumns`` (season, segment, cyclic parts, physics, lags)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions import timefeat as tf
from hourcast.operators import series


def add_calendar_features(df: DataFrame, time_col: str = "ObservationTime", with_weekday: bool = False) -> DataFrame:
    """Season, time segment and cyclic hour / month / day (script variant); weekday optional (notebook)."""
    cols = {"season": tf.season("month"), "time_segment": tf.time_segment("hour")}
    if with_weekday:
        cols["weekday"] = tf.weekday_index(time_col)
        cols.update(tf.cyclic_features(weekday=F.col("weekday")))
    else:
        cols.update(tf.cyclic_features())
    return df.withColumns(cols)


def add_physics_features(df: DataFrame) -> DataFrame:
    """F13-F16 (notebook variant)."""
    return df.withColumns(tf.physics_features())


def add_features(df: DataFrame, keys=("StationID",), time_col: str = "ObservationTime",
                 target: str = "Temperature", extended: bool = False) -> DataFrame:
    """M3: the script features; ``extended`` adds the notebook ones (physics, weekday, 24-row
    difference of the target ordered by time, then back-fill of its leading nulls)."""
    out = add_calendar_features(df, time_col, with_weekday=extended)
    if extended:
        out = add_physics_features(out)
        out = series.ordinal(out, keys, time_col, "_pos")
        out = series.diff_by_position(out, keys, "_pos", target, 24, f"{target}_diff24")
        out = series.backfill(out, keys, time_col, [f"{target}_diff24"]).drop("_pos")
    return out
