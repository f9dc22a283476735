"""Cleaning and projection operators.

All are single-pass column expressions or plain selects; the schema-dependent column choices
(which columns are numeric / text) are made on ``df.schema`` in the driver, never on data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.schema import (IMPOSSIBLE_NEGATIVE_COLUMNS, LEADING_COLUMNS, MISSING_REPLACEMENT,
                             MISSING_TOKEN, TIME_PART_COLUMNS, categorical_columns, numeric_columns)


def replace_missing_token(df: DataFrame, token: str = MISSING_TOKEN, replacement: str = MISSING_REPLACEMENT,
                          columns=None) -> DataFrame:
    """Whole-cell ``'-'`` -> ``'Other'`` in text columns (other cells untouched)."""
    cols = columns or categorical_columns(df.schema)
    return df.withColumns({c: F.when(F.col(c) == F.lit(token), F.lit(replacement)).otherwise(F.col(c))
                           for c in cols if c in df.columns})


def clamp_negative(df: DataFrame, columns=IMPOSSIBLE_NEGATIVE_COLUMNS) -> DataFrame:
    """Negative -> 0 in the listed columns that exist; null and NaN are kept."""
    return df.withColumns({c: F.when(F.col(c) < 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c in columns if c in df.columns})


def drop_existing(df: DataFrame, columns, protect=LEADING_COLUMNS) -> DataFrame:
    """Drop the listed columns that exist, never the protected ones."""
    return df.drop(*[c for c in columns if c in df.columns and c not in protect])


def lead_columns(df: DataFrame, first=LEADING_COLUMNS) -> DataFrame:
    """Put ``first`` (those that exist) in front, keep the rest in order."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def drop_time_parts(df: DataFrame, keep_hour: bool = False) -> DataFrame:
    """P5: drop year, month, day, hour (the notebook variant keeps hour)."""
    return df.drop(*[c for c in TIME_PART_COLUMNS if not (keep_hour and c == "hour")])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts; text -> number goes through ``try_cast`` so bad text becomes null."""
    out = {}
    for c, t in types.items():
        if c not in df.columns:
            continue
        src = df.schema[c].dataType
        out[c] = F.col(c).try_cast(t) if isinstance(src, T.StringType) else F.col(c).cast(t)
    return df.withColumns(out)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P9."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def exclude_values(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose ``col`` is one of ``values``."""
    return df.filter(~F.col(col).isin(list(values)))


def align_features(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Exactly ``columns`` in that order; missing ones are added as ``fill``; extras dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def column_profile(df: DataFrame) -> DataFrame:
    """P7 (re-aimed): one row per column with type class, non-null count and exact distinct count.

    One aggregation pass computes all counts; ``stack`` turns the wide row into long form.
    """
    fields = df.schema.fields
    aggs = []
    for f in fields:
        aggs += [F.count(F.col(f"`{f.name}`")).alias(f"nn__{f.name}"),
                 F.count_distinct(F.col(f"`{f.name}`")).alias(f"nd__{f.name}")]
    wide = df.agg(*aggs)
    entries = []
    for pos, f in enumerate(fields):
        kind = "numeric" if isinstance(f.dataType, T.NumericType) else (
            "categorical" if isinstance(f.dataType, T.StringType) else "other")
        entries.append(F.struct(F.lit(pos).alias("position"), F.lit(f.name).alias("column"),
                                F.lit(kind).alias("kind"), F.lit(f.dataType.simpleString()).alias("spark_type"),
                                F.col(f"`nn__{f.name}`").alias("non_null"),
                                F.col(f"`nd__{f.name}`").alias("n_distinct")))
    return wide.select(F.inline(F.array(*entries)))


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """P13 / U2 (re-aimed): column comparison plus row differences on the shared columns.

    Rows: one per column name with ``status`` in {both, only_left, only_right} and the positions;
    plus two rows ``__rows_only_left__`` / ``__rows_only_right__`` with the rows that the other
    side lacks (bag semantics, one shuffle on all shared columns).
    """
    ac, bc = a.columns, b.columns
    shared = [c for c in ac if c in bc]
    spark = a.sparkSession
    meta = []
    for c in sorted(set(ac) | set(bc)):
        pa = ac.index(c) if c in ac else None
        pb = bc.index(c) if c in bc else None
        status = "both" if pa is not None and pb is not None else ("only_left" if pb is None else "only_right")
        meta.append((c, status, pa, pb, None))
    schema = "column string, status string, left_position int, right_position int, n_rows bigint"
    cols_df = spark.createDataFrame(meta, schema)
    if shared:
        # Signed counts of equal rows: what is left over on either side, in one aggregation.
        both = a.select(*shared).withColumn("__side", F.lit(1)).unionByName(b.select(*shared).withColumn("__side", F.lit(-1)))
        rest = both.groupBy(*shared).agg(F.sum("__side").alias("d")).agg(
            F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("l"), F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("r"))
        name = lambda side, n: F.struct(F.lit(f"__rows_only_{side}__").alias("column"), F.lit("rows").alias("status"),
                                        F.lit(None).cast("int").alias("left_position"), F.lit(None).cast("int").alias("right_position"), F.col(n).alias("n_rows"))
        return cols_df.unionByName(rest.select(F.inline(F.array(name("left", "l"), name("right", "r")))))
    return cols_df


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name, duplicates kept, missing columns filled with null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)

