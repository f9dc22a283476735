"""Observation text -> typed rows.

Lines starting with ``#`` are comments; fields are split on runs of whitespace; there is no header.
Rows whose field count is not 46 go to a rejects frame instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions import timefeat as tf
from hourcast.schema import RAW_SCHEMA, WEATHER_COLUMNS


def _fields(value: Column) -> Column:
    return F.split(F.trim(value), r"\s+")


def parse_observation_lines(lines: DataFrame, value_col: str = "value",
                            names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Return (parsed, rejects). ``names`` may be the Korean list (same order, same types)."""
    names = names or WEATHER_COLUMNS
    body = lines.filter(~F.col(value_col).startswith("#") & (F.length(F.trim(F.col(value_col))) > 0))
    parts = _fields(F.col(value_col))
    with_parts = body.withColumn("_f", parts)
    good = with_parts.filter(F.size("_f") == len(names))
    rejects = with_parts.filter(F.size("_f") != len(names)).select(
        F.col(value_col).alias("line"), F.size("_f").alias("n_fields"))
    cols = []
    for i, (field, name) in enumerate(zip(RAW_SCHEMA.fields, names)):
        raw = F.get(F.col("_f"), i)
        if field.name == "ObservationTime":
            c = tf.parse_obs_time(raw)
        else:
            c = raw.try_cast(field.dataType)
        cols.append(c.alias(name))
    parsed = good.select(*cols)
    t = names[0]
    parsed = parsed.withColumns(tf.time_parts(t))
    return parsed, rejects


def render_observation_lines(obs: DataFrame) -> DataFrame:
    """Inverse of the parser: one whitespace-separated line per observation (``value`` column).

    Null numerics are written as ``-9`` (the source's missing marker), text as is.
    """
    fields = []
    for f in RAW_SCHEMA.fields:
        c = F.col(f.name)
        if f.name == "ObservationTime":
            fields.append(tf.format_obs_time(c))
        else:
            fields.append(F.coalesce(c.cast("string"), F.lit("-9")))
    return obs.select(F.concat_ws(" ", *fields).alias("value"))


def read_observation_text(spark, path: str, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    return parse_observation_lines(spark.read.text(path), names=names)
