"""Value counts with offsets (W3): the distributed base of average ranks and exact quantiles.

Input is long form ``(keys..., value)`` (e.g. ``column, value`` after ``unpivot``). Output has one
row per distinct (keys, value) with ``cnt`` (rows holding the value) and ``less`` (rows of the same
key holding a smaller value). Then

* average rank (ties share the mean rank)  = less + (cnt + 1) / 2,
* the i-th smallest value (0-based)        = value with less <= i < less + cnt.

How it scales: ``groupBy(keys, value)`` combines duplicates map-side (a value holding a third of all
rows becomes one row). The running count over values would need one window per key; instead each
key's distinct values are cut into ``n_buckets`` equal ranges by ``percentile_approx`` cut points
(a map-side sketch, collected once as literals so every branch of the plan buckets identically;
text values use pivots from a bounded hash sample of their distinct values), bucket totals (keys x buckets
rows) get prefix sums, and the final running sum runs per (key, bucket). No step sees all values
of a key in one task. The input is read once: the counts are kept, and all that follows reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.session import cut_lineage

N_BUCKETS = 64  # buckets of a key with up to N_BUCKETS * VALUES_PER_BUCKET distinct values; more for more
VALUES_PER_BUCKET = 1_000_000
MAX_BROADCAST_ROWS = 1_000_000  # of a bucket table; a larger one is joined by its keys


def _hinted(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= MAX_BROADCAST_ROWS else small


def bucket_bounds(counts: DataFrame, keys, value_col: str = "value", n_buckets: int = N_BUCKETS) -> dict:
    """Approximate equal-count cut points of ``value_col``, per key, as driver literals.

    The result has keys x (buckets - 1) doubles. Collecting it once pins the bucketing: every later
    use sees the same cut points, whatever the merge order of the sketch. A key with more than
    ``n_buckets * VALUES_PER_BUCKET`` distinct values is sketched again with as many buckets as keep
    a bucket at that size.
    """
    def sketch(n: int, *more: Column):
        probs = [i / n for i in range(1, n)]
        # cut points need ~1/n rank resolution: a sketch of 16 n is ample and much cheaper than the default
        return counts.groupBy(*keys).agg(F.percentile_approx(value_col, probs, 16 * n).alias("_b"), *more).collect()

    rows = sketch(n_buckets, F.approx_count_distinct(value_col).alias("_nd"))
    most = max((r["_nd"] for r in rows), default=0)
    if most > n_buckets * VALUES_PER_BUCKET:
        rows = sketch(-(-most // VALUES_PER_BUCKET))
    return {tuple(r[k] for k in keys): sorted(set(x for x in (r["_b"] or []) if x is not None)) for r in rows}


def text_pivots(counts: DataFrame, keys, value_col: str = "value", n_buckets: int = N_BUCKETS,
                per_bucket: int = 32) -> dict:
    """Order-preserving cut points for text values: a hash sample of about
    ``n_buckets * per_bucket`` distinct values per key (rate from an HLL distinct count), sorted on
    the driver (code-point order = Spark's UTF-8 byte order), every ``per_bucket``-th kept.
    Both collections are bounded by ``keys x n_buckets x per_bucket`` values."""
    nd = {tuple(r[k] for k in keys): r["_nd"] for r in
          counts.groupBy(*keys).agg(F.approx_count_distinct(value_col).alias("_nd")).collect()}
    if not nd:
        return {}
    n_buckets = max(n_buckets, -(-max(nd.values()) // VALUES_PER_BUCKET))
    want = n_buckets * per_bucket
    # One row for each key, joined: the expression per row stays small whatever the number of keys.
    spark = counts.sparkSession
    rates = spark.createDataFrame([(*key, min(1.0, want / max(n, 1))) for key, n in nd.items()],
                                  T.StructType([*[counts.schema[k] for k in keys], T.StructField("_rate", T.DoubleType())]))
    u = (F.pmod(F.xxhash64(F.col(value_col)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    sample = counts.join(_hinted(rates, len(nd)), list(keys)).filter(u < F.col("_rate")).select(*keys, value_col).collect()
    by_key: dict = {}
    for r in sample:
        by_key.setdefault(tuple(r[k] for k in keys), []).append(r[value_col])
    out = {}
    for key, vals in by_key.items():
        vals = sorted(vals)
        step = max(1, len(vals) // n_buckets)
        out[key] = vals[step::step][: n_buckets - 1]
    return out


def with_bucket(counts: DataFrame, bounds: dict, keys, value_col: str = "value") -> DataFrame:
    """Add ``_bk`` = number of the key's cut points below the value.

    The cut points travel as a tiny literal table (one row per key, built from the collected
    values, so it is identical in every branch of the plan) joined by broadcast: the expression
    per row stays small whatever the number of keys.
    """
    keys = list(keys)
    spark = counts.sparkSession
    vtype = counts.schema[value_col].dataType
    fields = [counts.schema[k] for k in keys] + [T.StructField("_cuts", T.ArrayType(vtype))]
    rows = [tuple(key) + ([float(x) for x in cuts] if not isinstance(vtype, T.StringType) else list(cuts),)
            for key, cuts in bounds.items()]
    table = spark.createDataFrame(rows, T.StructType(fields))
    v = F.col(value_col)
    out = counts.join(_hinted(table, sum(len(c) for c in bounds.values())), keys, "left")
    return out.withColumn("_bk", F.coalesce(F.size(F.filter(F.col("_cuts"), lambda b: b < v)), F.lit(0))).drop("_cuts")


def bucketed_counts(long_df: DataFrame, keys, value_col: str = "value", n_buckets: int = N_BUCKETS,
                    distinct_only: bool = False, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(counts with bucket ``_bk``, bucket table with ``_bn`` rows, ``_boff`` rows before, ``_n`` total).

    Text values are bucketed by pivots drawn from a bounded hash sample of their distinct values.
    ``weight`` names a count column of rows that stand for several.
    """
    keys = list(keys)
    is_text = isinstance(long_df.schema[value_col].dataType, T.StringType)
    valid = F.col(value_col).isNotNull() if is_text else (F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col)))
    rows = long_df.filter(valid)
    counts = cut_lineage(rows.groupBy(*keys, value_col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("cnt")))
    if distinct_only:
        counts = counts.withColumn("cnt", F.lit(1).cast("long"))
    if is_text:
        bounds = text_pivots(counts, keys, value_col, n_buckets)
        c = with_bucket(counts, bounds, keys, value_col)
    else:
        # a bucket holds ~1/n_buckets of the distinct values, which are the rows from here on
        bounds = bucket_bounds(counts, keys, value_col, n_buckets)
        c = with_bucket(counts, bounds, keys, value_col)
    tot = c.groupBy(*keys, "_bk").agg(F.sum("cnt").alias("_bn"))
    w_prev = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*keys)
    # keys x buckets rows
    tot = tot.select(*keys, "_bk", "_bn", F.coalesce(F.sum("_bn").over(w_prev), F.lit(0)).alias("_boff"),
                     F.sum("_bn").over(w_all).alias("_n"))
    return c, _hinted(tot, sum(len(b) + 1 for b in bounds.values()))


def _running_less(c: DataFrame, tot: DataFrame, keys, value_col: str) -> DataFrame:
    c = c.join(tot, list(keys) + ["_bk"])
    w_in = Window.partitionBy(*keys, "_bk").orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    return c.withColumn("less", (F.col("_boff") + F.coalesce(F.sum("cnt").over(w_in), F.lit(0))).cast("long"))


def value_offsets(long_df: DataFrame, keys, value_col: str = "value", n_buckets: int = N_BUCKETS,
                  distinct_only: bool = False, weight: str | None = None) -> DataFrame:
    """(keys, value, cnt, less) per distinct value; ``distinct_only`` counts each value once, so
    ``less`` becomes the 0-based index of the value among the sorted distinct values."""
    keys = list(keys)
    c, tot = bucketed_counts(long_df, keys, value_col, n_buckets, distinct_only, weight)
    out = _running_less(c, tot, keys, value_col)
    return out.select(*keys, value_col, F.col("cnt").cast("long").alias("cnt"), "less")


def average_ranks(long_df: DataFrame, keys, value_col: str = "value", rank_col: str = "rank",
                  n_buckets: int = N_BUCKETS, weight: str | None = None) -> DataFrame:
    """Rank table (keys, value, cnt, rank) with the average rank of each distinct value."""
    off = value_offsets(long_df, keys, value_col, n_buckets, weight=weight)
    return off.withColumn(rank_col, F.col("less") + (F.col("cnt") + F.lit(1)) / F.lit(2.0))


def exact_quantiles(long_df: DataFrame, keys, probs, value_col: str = "value",
                    n_buckets: int = N_BUCKETS, weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / numpy default), one row per (keys, p).

    h = (n - 1) * p; q = x[floor h] + (h - floor h) * (x[floor h + 1] - x[floor h]).
    Only the buckets holding floor h or ceil h are ranked (a broadcast semi join on the bucket
    table), so the running-sum window touches a few buckets per key instead of all of them.
    ``weight`` names a count column of rows that stand for several.
    """
    keys = list(keys)
    c, tot = bucketed_counts(long_df, keys, value_col, n_buckets, weight=weight)
    ps = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    t = tot.withColumn("p", ps).withColumn("_h", (F.col("_n") - 1) * F.col("p"))
    t = t.withColumn("_lo", F.floor("_h")).withColumn("_hi", F.ceil("_h"))
    inside = lambda i: (F.col("_boff") <= F.col(i)) & (F.col(i) < F.col("_boff") + F.col("_bn"))
    need = t.filter(inside("_lo") | inside("_hi")).select(*keys, "_bk").distinct()
    x = _running_less(c.join(need, keys + ["_bk"], "left_semi"), tot, keys, value_col)
    x = x.withColumn("p", ps).withColumn("_h", (F.col("_n") - 1) * F.col("p"))
    x = x.withColumn("_lo", F.floor("_h")).withColumn("_hi", F.ceil("_h"))
    hit_lo = (F.col("less") <= F.col("_lo")) & (F.col("_lo") < F.col("less") + F.col("cnt"))
    hit_hi = (F.col("less") <= F.col("_hi")) & (F.col("_hi") < F.col("less") + F.col("cnt"))
    x = x.filter(hit_lo | hit_hi)
    q = x.groupBy(*keys, "p").agg(
        F.max(F.when(hit_lo, F.col(value_col))).alias("_xlo"),
        F.max(F.when(hit_hi, F.col(value_col))).alias("_xhi"),
        F.first("_h").alias("_h"), F.first("_lo").alias("_lo"))
    return q.select(*keys, "p", (F.col("_xlo") + (F.col("_h") - F.col("_lo")) * (F.col("_xhi") - F.col("_xlo")))
                    .alias("q"))
