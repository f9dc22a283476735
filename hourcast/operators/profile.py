"""Profiling operators.

Per-column statistics are computed in one pass: the frame is unpivoted to long form
``(column, value)`` and grouped by ``column`` (and value where needed), rather than one job per
column. Only schema-sized tables (one row per column) ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.functions.numeric import null_if_nan, round_exact
from hourcast.operators.ranks import exact_quantiles
from hourcast.schema import MISSING_TOKEN, numeric_columns
from hourcast.session import cut_lineage


def to_long(df: DataFrame, columns, ids=(), value_type: str = "double") -> DataFrame:
    """Unpivot ``columns`` to (ids..., column, value) with a common value type; NaN is missing."""
    cast = lambda c: F.col(f"`{c}`").cast(value_type)
    casted = df.select(*ids, *[(null_if_nan(cast(c)) if value_type == "double" else cast(c)).alias(c) for c in columns])
    return casted.unpivot(list(ids), list(columns), "column", "value")


def describe(df: DataFrame, columns=None) -> DataFrame:
    """Count, mean, std (sample), min, 25 %, 50 %, 75 %, max per numeric column (transposed).

    Quantiles are exact (linear interpolation) from ``exact_quantiles``; std is null for n < 2.
    """
    cols = columns or numeric_columns(df.schema)
    long = to_long(df, cols)
    # one global aggregation row (present even for an empty frame), then one struct per column
    aggs = []
    for i, c in enumerate(cols):
        v = null_if_nan(F.col(f"`{c}`").cast("double"))
        aggs += [F.count(v).alias(f"c{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                        F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
               for i, c in enumerate(cols)]
    base = df.agg(*aggs).select(F.inline(F.array(*entries)))
    q = exact_quantiles(long, ["column"], [0.25, 0.5, 0.75])
    qw = q.groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qw = qw.withColumnsRenamed({"0.25": "p25", "0.5": "p50", "0.75": "p75"})
    return base.join(qw, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_all(df: DataFrame) -> DataFrame:
    """A9 for every column: count, unique, top and freq (text and other columns), beside the numeric statistics.

    ``top`` is the most frequent value (the least one among equals) and null for numeric columns. Values are
    counted by (column, value), so a frequent value is combined within tasks first.
    """
    numeric = numeric_columns(df.schema)
    other = [c for c in df.columns if c not in numeric]
    stats = describe(df, numeric) if numeric else None
    if not other:
        return stats.select("column", "count", *[F.lit(None).cast(t).alias(n) for n, t in (("unique", "long"), ("top", "string"), ("freq", "long"))],
                            *stats.columns[2:])
    counts = to_long(df, other, value_type="string").where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                       F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("t"))
    names = df.sparkSession.createDataFrame([(c,) for c in other], "column string")
    text = names.join(top, "column", "left").select("column", F.coalesce("count", F.lit(0)).alias("count"),
                                                    F.coalesce("unique", F.lit(0)).alias("unique"), F.col("t.value").alias("top"), (-F.col("t.n")).alias("freq"))
    return text if stats is None else text.unionByName(stats, allowMissingColumns=True)


def iqr_bounds(df: DataFrame, columns=None, threshold: float = 1.5) -> DataFrame:
    """A10 pass 1: q1, q3, lower and upper fences per column."""
    cols = columns or numeric_columns(df.schema)
    return _fences(exact_quantiles(to_long(df, cols), ["column"], [0.25, 0.75]), threshold)


def _fences(q: DataFrame, threshold: float) -> DataFrame:
    w = q.groupBy("column").pivot("p", [0.25, 0.75]).agg(F.first("q")).withColumnsRenamed({"0.25": "q1", "0.75": "q3"})
    iqr = F.col("q3") - F.col("q1")
    return w.withColumns({"lower": F.col("q1") - F.lit(threshold) * iqr, "upper": F.col("q3") + F.lit(threshold) * iqr})


def outlier_iqr(df: DataFrame, columns=None, threshold: float = 1.5, digits: int = 3) -> DataFrame:
    """A10: outlier count and ratio (%) per column, strict fences, sorted by ratio descending.

    The frame is read once: equal (column, value) are counted within tasks, and the quartiles and both counts come
    from these cells. The fence table has one row per column, so its join is broadcast by its bounded size.
    """
    cols = columns or numeric_columns(df.schema)
    cells = cut_lineage(to_long(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))
    b = _fences(exact_quantiles(cells, ["column"], [0.25, 0.75], weight="cnt"), threshold)
    j = cells.join(F.broadcast(b), "column", "left")
    beyond = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    cnt = j.groupBy("column").agg(
        F.sum("cnt").alias("n"),
        F.sum(F.when(beyond, F.col("cnt")).otherwise(F.lit(0))).alias("outlier_count"))
    return (cnt.select(F.col("column").alias("Column"), F.col("outlier_count").alias("Outlier Count"),
                       round_exact(F.col("outlier_count") / F.col("n") * 100, digits).alias("Outlier Ratio (%)"))
            .orderBy(F.desc("Outlier Ratio (%)")))


def negative_columns(df: DataFrame, columns=None) -> DataFrame:
    """Per numeric column, does any value fall below 0 (one aggregation pass)."""
    cols = columns or numeric_columns(df.schema)
    wide = df.agg(*[F.coalesce(F.bool_or(null_if_nan(F.col(f"`{c}`").cast("double")) < 0), F.lit(False)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "has_negative")


def null_and_token_counts(df: DataFrame, token: str = MISSING_TOKEN) -> DataFrame:
    """A5: per column, null count and (text columns) count of cells equal to ``token``."""
    aggs, entries = [], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"n__{f.name}"))
        is_text = isinstance(f.dataType, T.StringType)
        aggs.append((F.count_if(c == F.lit(token)) if is_text else F.lit(0).cast("long")).alias(f"t__{f.name}"))
        entries.append(F.struct(F.lit(f.name).alias("column"), F.col(f"`n__{f.name}`").alias("null_count"),
                                F.col(f"`t__{f.name}`").alias("token_count")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def distinct_counts(df: DataFrame, columns, approx: bool = False) -> DataFrame:
    """A4: distinct (non-null) values per column: exact via grouping in long form, or HLL."""
    long = to_long(df, columns, value_type="string").filter(F.col("value").isNotNull())
    if approx:
        return long.groupBy("column").agg(F.approx_count_distinct("value").alias("n_distinct"))
    return long.select("column", "value").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A4: the distinct values of one column, sorted."""
    return df.select(column).distinct().orderBy(column)


def histogram(df: DataFrame, columns=None, bins: int = 30, label: str | None = None) -> DataFrame:
    """Equal-width bins between each column's min and max (last bin closed), counts per bin.

    ``label`` tags the rows, so the two-frame form is ``histogram(a, label='a').union(histogram(b, ...))``
    (each frame gets its own range, as when each is drawn on its own).
    """
    cols = columns or numeric_columns(df.schema)
    long = to_long(df, cols).filter(F.col("value").isNotNull())
    rng = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.join(F.broadcast(rng), "column")
    width = F.col("hi") - F.col("lo")
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * F.lit(bins)), F.lit(bins - 1)))
    h = j.groupBy("column", idx.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    out = h.select("column", (F.col("bin") + 1).alias("bin"),
                   (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / F.lit(bins)).alias("bin_low"),
                   (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") + 1) / F.lit(bins)).alias("bin_high"),
                   "count")
    return out.withColumn("label", F.lit(label)) if label is not None else out


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
