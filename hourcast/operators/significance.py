"""Statistical tests against a target (A12-A15), normality (A17) and correlation-based selection (M1, M2).

Each test turns the frame into long form once, does the per-column work as grouped aggregations
(ranks via ``ranks.average_ranks``), and ends with a one-row-per-feature table; only there do the
p-value tails run (pandas UDF on a handful of rows).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions.numeric import null_if_nan
from hourcast.functions.pvalues import chi2_sf_udf, t_two_sided_udf
from hourcast.operators.gram import column_sums, pair_correlations
from hourcast.operators.profile import to_long
from hourcast.operators.ranks import average_ranks, value_offsets
from hourcast.schema import categorical_columns, numeric_columns
from hourcast.session import cut_lineage

ALPHA = 0.05
FREQUENT_VALUES = 10_000  # of a column whose ranks travel to the tasks
TIE_TOLERANCE = 1e-12


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r over the complete pairs, as an aggregate; null (not an error) when either side is constant."""
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _t_stat(r: Column, n: Column) -> Column:
    return r * F.sqrt(F.try_divide(n - 2, (F.lit(1.0) - r) * (F.lit(1.0) + r)))


def rank_columns(df: DataFrame, columns, most: int = FREQUENT_VALUES) -> DataFrame:
    """The rows of ``df`` with the average rank of each of ``columns`` in its place (null where there is no value).

    Rows stay wide. Ranks of frequent values, at most ``most`` for each column, go to the tasks and are looked up in
    Arrow batches, so a hot value meets no shuffle. A column with more values has its other ones, of which none holds
    more than 1 / ``most`` of the rows, joined by value; rows that need no such rank are dealt out by their hash.
    """
    columns = list(columns)
    number = [null_if_nan(F.col(f"`{c}`").cast("double")).alias(f"x{i}") for i, c in enumerate(columns)]
    rows = df.select(*number)
    ranks = cut_lineage(average_ranks(to_long(rows, rows.columns), ["column"]).select("column", "value", "cnt", "rank"))
    size = {r["column"]: r for r in ranks.groupBy("column").agg(F.count(F.lit(1)).alias("nd"), F.sum("cnt").alias("n")).collect()}
    # A value stays with the rare ones if its count is below this: columns-sized literals.
    least = {x: 0 if r["nd"] <= most else -(-r["n"] // most) for x, r in size.items()}
    rare = [i for i, x in enumerate(rows.columns) if least.get(x, 0) > 0]
    bar = F.element_at(F.create_map(*[F.lit(v) for x, n in least.items() for v in (x, n)]), F.col("column")) if least else F.lit(0)
    known = ranks.where(F.col("cnt") >= bar).select("column", "value", "rank").toArrow()
    names, values, places = np.array(known["column"].to_pylist(), dtype=object), known["value"].to_numpy(), known["rank"].to_numpy()
    tables = []
    for x in rows.columns:
        own = np.flatnonzero(names == x)
        own = own[np.argsort(values[own], kind="stable")]
        tables.append((values[own], places[own]))
    width = len(columns)

    def look_up(batches):
        for batch in batches:
            out, left = [], []
            for i, (v, r) in enumerate(tables):
                x = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)
                found = np.full(len(x), np.nan)
                if len(v):
                    at = np.minimum(np.searchsorted(v, x), len(v) - 1)
                    found = np.where(v[at] == x, r[at], np.nan)
                out.append(found)
                if i in rare:
                    left.append(np.where(np.isnan(found), x, np.nan))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.float64(), from_pandas=True) for a in out + left],
                                             names=[f"x{i}" for i in range(width)] + [f"v{i}" for i in rare])

    out = rows.mapInArrow(look_up, ", ".join([f"x{i} double" for i in range(width)] + [f"v{i} double" for i in rare]))
    for i in rare:
        mine = ranks.where((F.col("column") == f"x{i}") & (F.col("cnt") < least[f"x{i}"])).select(
            F.col("value").alias("_v"), F.lit(0).cast("long").alias("_salt"), F.col("rank").alias("_r"))
        spread = F.when(F.col(f"v{i}").isNull(), 1 + F.pmod(F.xxhash64(*out.columns), F.lit(1 << 30))).otherwise(F.lit(0).cast("long"))
        out = (out.withColumns({"_v": F.coalesce(F.col(f"v{i}"), F.lit(0.0)), "_salt": spread}).join(mine, ["_v", "_salt"], "left")
               .withColumn(f"x{i}", F.coalesce(F.col(f"x{i}"), F.col("_r"))).drop("_v", "_salt", "_r", f"v{i}"))
    return out.select(*[F.col(f"x{i}").alias(c) for i, c in enumerate(columns)])


def spearman(df: DataFrame, target: str, features=None, sort: bool = True) -> DataFrame:
    """Spearman rho of each numeric feature vs the target, with t and n.

    Rows stay wide: the target and every feature have their ranks put in place, and each task sums its products.
    A feature (or target) with any null gives rho = null (pandas 'propagate'); a constant column
    gives null as well. Sorted by correlation descending.
    """
    feats = list(features or numeric_columns(df.schema, exclude=(target,)))
    cols = feats + [target]
    n_rows = df.count()
    # Complete columns only: both mean ranks are (N + 1) / 2, taken off before the sums.
    sums = column_sums(rank_columns(df, cols), cols, target, (n_rows + 1) / 2).where(F.lit(n_rows) > 0)
    r = F.when(F.col("n") == n_rows, F.try_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy")))
    out = sums.select(F.col("f1").alias("Feature"), r.alias("Correlation"), F.lit(n_rows).cast("long").alias("n"))
    out = out.withColumn("t", _t_stat(F.col("Correlation"), F.col("n")))
    return out.orderBy(F.desc("Correlation")) if sort else out


def spearman_test(df: DataFrame, target: str, features=None, sort: bool = True) -> DataFrame:
    """A12 with p-values (two-sided t with n - 2 degrees of freedom)."""
    s = spearman(df, target, features, sort=False)
    p = F.when(F.abs(F.col("Correlation")) >= 1.0, F.lit(0.0)).otherwise(
        t_two_sided_udf(F.col("t"), (F.col("n") - 2).cast("double")))
    out = s.withColumn("P-value", p)
    return out.orderBy(F.desc("Correlation")) if sort else out


def insignificant(report: DataFrame, name_col: str, p_col: str, alpha: float = ALPHA) -> DataFrame:
    """P10: features whose p >= alpha; NaN / null p is *not* >= alpha (pandas comparison rule)."""
    p = F.col(p_col)
    return report.filter(p.isNotNull() & ~F.isnan(p) & (p >= alpha)).select(name_col)


def pearson_with_target(df: DataFrame, target: str, features=None, threshold: float = 0.0,
                        method: str = "pearson") -> DataFrame:
    """Correlation with the target, |r| >= threshold, sorted descending (pearson or spearman)."""
    feats = features or numeric_columns(df.schema, exclude=(target,))
    if method == "spearman":
        r = spearman(df, target, feats, sort=False).select(F.col("Feature").alias("column"), F.col("Correlation").alias("r"))
    else:
        wide = df.agg(*[safe_corr(F.col(f"`{c}`").cast("double"), F.col(target).cast("double")).alias(c) for c in feats])
        r = wide.unpivot([], feats, "column", "r")
    return r.filter(F.abs("r") >= threshold).orderBy(F.desc("r"))


def corr_matrix(df: DataFrame, features, method: str = "pearson") -> DataFrame:
    """Correlation of every feature pair (f1 before f2 in ``features`` order) in long form, over the pair's complete rows.

    Pearson: blocked matrix products (``gram``), so the plan does not grow with the pairs.
    Spearman: ranks put in place of the values, then the same products. Columns with gaps are
    ranked anew over the rows of each mask; a column without any value has null with every other.
    """
    feats = list(features)
    found = _spearman_pairs(df, feats) if method == "spearman" else pair_correlations(df, feats)
    at = {c: i for i, c in enumerate(feats)}
    pairs = df.sparkSession.createDataFrame([(a, b, at[a], at[b]) for a, b in itertools.combinations(feats, 2)], "f1 string, f2 string, i1 int, i2 int")
    # One row for each pair on both sides; a pair is found in one of its two orders.
    key = lambda a, b: (F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b"))
    found = found.select(*key("f1", "f2"), "r")
    return pairs.select("*", *key("f1", "f2")).join(F.broadcast(found), ["_a", "_b"], "left").select("f1", "f2", "i1", "i2", "r")


def _spearman_pairs(df: DataFrame, feats: list[str]) -> DataFrame:
    """(f1, f2, r) of the pairs that have one."""
    held = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(_number(c)).alias(f"c{i}") for i, c in enumerate(feats)]).first()
    count = {c: held[f"c{i}"] for i, c in enumerate(feats)}
    holed = [c for c in feats if 0 < count[c] < held["n"]]
    whole = [c for c in feats if count[c] == held["n"]]
    found = _spearman_whole(df, whole)
    return found.unionByName(_spearman_with_gaps(df, whole, holed)) if holed else found


def _number(c: str) -> Column:
    return null_if_nan(F.col(f"`{c}`").cast("double"))


def _spearman_whole(df: DataFrame, feats: list[str]) -> DataFrame:
    """(f1, f2, r) of columns without gaps: each column is ranked once, over all rows."""
    if len(feats) < 2:
        return df.sparkSession.createDataFrame([], "f1 string, f2 string, r double")
    return pair_correlations(cut_lineage(rank_columns(df, feats)), feats).select("f1", "f2", "r")


def _spearman_with_gaps(df: DataFrame, whole: list[str], holed: list[str]) -> DataFrame:
    """(f1, f2, r) of the pairs with a column that has gaps, f1 being the mask's column.

    A mask is the rows where one such column, or both of two, have values. Every column of a mask is ranked
    over its rows; the mask's own column once. Equal (mask, column, x, y) are counted first, so hot values
    shrink within tasks, and all that follows works on these cells.
    """
    masks = [(g, list(whole)) for g in holed] + [(g, [c]) for g, c in itertools.combinations(holed, 2)]
    long = df.select(F.inline(F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(c).alias("column"), _number(c).alias("x"), _number(g).alias("y"))
                                        for m, (g, cols) in enumerate(masks) for c in cols]))).where("x is not null and y is not null")
    cells = long.groupBy("mask", "column", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    key = ["mask", "column"]
    rx = average_ranks(cells.select(*key, F.col("x").alias("value"), "n"), key, weight="n").select(*key, F.col("value").alias("x"), F.col("rank").alias("rx"))
    one = F.element_at(F.array(*[F.lit(cols[0] if cols else "") for _, cols in masks]), F.col("mask") + 1)
    own = cells.where(F.col("column") == one).select("mask", F.col("y").alias("value"), "n")
    ry = average_ranks(own, ["mask"], weight="n").select("mask", F.col("value").alias("y"), F.col("rank").alias("ry"))
    total = own.groupBy("mask").agg(F.sum("n").alias("_all"))  # one row for each mask
    c = cells.join(rx, [*key, "x"]).join(ry, ["mask", "y"]).join(F.broadcast(total), "mask")
    # Pearson of the ranks with weights n; ranks are centred on their mean (N + 1) / 2 first.
    x, y = F.col("rx") - (F.col("_all") + 1) / 2, F.col("ry") - (F.col("_all") + 1) / 2
    s = lambda e: F.sum(F.col("n") * e)
    r = F.try_divide(s(x * y), F.sqrt(s(x * x)) * F.sqrt(s(y * y)))
    f1 = F.element_at(F.array(*[F.lit(g) for g, _ in masks]), F.col("mask") + 1)
    return c.groupBy(*key).agg(r.alias("r")).select(f1.alias("f1"), F.col("column").alias("f2"), "r")


def high_corr_drop(df: DataFrame, target: str, features=None, threshold: float = 0.95,
                   method: str = "spearman") -> DataFrame:
    """M2: for each pair with |r| > threshold keep the feature closer to the target.

    If |r(f1, target)| >= |r(f2, target)| drop f2, else drop f1 (NaN comparisons are false).
    Works on the features^2 pair table and the per-feature target table only.
    """
    feats = list(features or numeric_columns(df.schema, exclude=(target,)))
    # one matrix over features + target: the feature pairs and |r(feature, target)| in one pass
    m = corr_matrix(df, feats + [target], method)
    pairs = m.filter((F.col("f1") != target) & (F.col("f2") != target)).filter(
        F.coalesce(F.abs("r") > threshold, F.lit(False)))
    ct = m.filter(F.col("f2") == target).select(F.col("f1").alias("column"), F.abs("r").alias("ct"))
    j = (pairs.join(F.broadcast(ct.withColumnsRenamed({"column": "f1", "ct": "ct1"})), "f1", "left")
         .join(F.broadcast(ct.withColumnsRenamed({"column": "f2", "ct": "ct2"})), "f2", "left"))
    # equal |r| (e.g. identical rank vectors) must tie as in the reference: Spark's per-column sums
    # may run in different row orders, so compare with a tolerance far below any real difference
    drop = F.when(F.coalesce(F.col("ct1") >= F.col("ct2") - F.lit(TIE_TOLERANCE), F.lit(False)),
                  F.col("f2")).otherwise(F.col("f1"))
    return j.select(drop.alias("Feature")).distinct()


def kruskal(df: DataFrame, target: str, features=None, min_group_size: int = 5) -> DataFrame:
    """Kruskal-Wallis H of the target grouped by each categorical column.

    Groups below ``min_group_size`` rows are dropped; columns with fewer than two groups left are
    not reported. Ranks are taken over the surviving rows of each column, ties corrected:
    H = [12 / (N (N + 1)) * sum(R_j^2 / n_j) - 3 (N + 1)] / [1 - sum(t^3 - t) / (N^3 - N)].
    """
    feats = features or categorical_columns(df.schema, exclude=(target,))
    base = df.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    long = base.select(F.col(target).cast("double").alias("_y"),
                       *[F.col(f"`{c}`").cast("string").alias(c) for c in feats]).unpivot(
        ["_y"], feats, "column", "grp").filter(F.col("grp").isNotNull())
    # Equal (column, group, target) are counted within tasks first; all that follows works on these cells.
    cells = long.groupBy("column", "grp", "_y").agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy("column", "grp").agg(F.sum("n").alias("n_j")).filter(F.col("n_j") >= min_group_size)
    kept = cells.join(sizes.select("column", "grp"), ["column", "grp"], "left_semi")
    ranks = average_ranks(kept.select("column", F.col("_y").alias("value"), "n"), ["column"], weight="n")
    ties = ranks.groupBy("column").agg(F.sum(F.pow(F.col("cnt"), 3) - F.col("cnt")).alias("_ties"))
    j = kept.join(ranks.select("column", F.col("value").alias("_y"), "rank"), ["column", "_y"])
    g = j.groupBy("column", "grp").agg(F.sum(F.col("rank") * F.col("n")).alias("R_j"), F.sum("n").alias("n_j"))
    per = g.groupBy("column").agg(F.sum("n_j").alias("N"), F.count(F.lit(1)).alias("k"),
                                  F.sum(F.col("R_j") * F.col("R_j") / F.col("n_j")).alias("_s"))
    per = per.filter(F.col("k") >= 2).join(ties, "column")
    N = F.col("N").cast("double")
    h_raw = F.lit(12.0) / (N * (N + 1)) * F.col("_s") - F.lit(3.0) * (N + 1)
    h = F.try_divide(h_raw, F.lit(1.0) - F.col("_ties") / (N * N * N - N))
    return per.select(F.col("column").alias("feature"), h.alias("H-statistic"), "k", "N")


def kruskal_test(df: DataFrame, target: str, features=None, min_group_size: int = 5, sort: bool = True) -> DataFrame:
    """A15 with p = chi-square upper tail with k - 1 degrees of freedom, sorted by p."""
    k = kruskal(df, target, features, min_group_size)
    out = k.withColumn("p-value", chi2_sf_udf(F.col("H-statistic"), (F.col("k") - 1).cast("double")))
    return out.orderBy("p-value") if sort else out


def jarque_bera(df: DataFrame, features=None) -> DataFrame:
    """A17 (re-aimed normality test): JB = n / 6 * (S^2 + K^2 / 4) with population skewness S and
    excess kurtosis K (Spark's streaming central-moment aggregates)."""
    feats = features or numeric_columns(df.schema)
    long = to_long(df, feats).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    m = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.skewness("value").alias("skew"),
                                   F.kurtosis("value").alias("kurt"))
    jb = F.col("n") / F.lit(6.0) * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / F.lit(4.0))
    return m.withColumn("JB", jb)


def normality_test(df: DataFrame, features=None, alpha: float = ALPHA) -> DataFrame:
    """JB p-value = exp(-JB / 2) (chi-square, 2 df) and the split at p > alpha."""
    j = jarque_bera(df, features)
    p = F.exp(-F.col("JB") / F.lit(2.0))
    return j.withColumn("p-value", p).withColumn("normal", F.coalesce(p > alpha, F.lit(False)))


# Numerator and denominator of the upper normal tail divided by exp(-x^2 / 2), highest power first
# (published double-precision rational approximation, for x below the bound; a continued fraction beyond it).
TAIL_NUMERATOR = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
TAIL_DENOMINATOR = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948,
                    440.413735824752)
TAIL_BOUND, ROOT_TWO_PI = 7.07106781186547, 2.506628274631


def _horner(x: Column, coefficients) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def log_normal_cdf(z: Column) -> Column:
    """ln of the standard normal distribution function, precise in the lower tail (no underflow)."""
    x = F.abs(z)
    fraction = x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + F.lit(0.65)))))
    ratio = F.when(x < TAIL_BOUND, _horner(x, TAIL_NUMERATOR) / _horner(x, TAIL_DENOMINATOR)).otherwise(1 / (fraction * ROOT_TWO_PI))
    log_tail = -x * x / 2 + F.log(ratio)
    return F.when(z <= 0, log_tail).otherwise(F.log1p(-F.exp(log_tail)))


# P of the corrected statistic a, as exp(c0 + c1 a + c2 a^2) from a bound on, or 1 less that.
AD_P = ((0.6, 1.2937, -5.709, 0.0186, False), (0.34, 0.9177, -4.279, -1.38, False), (0.2, -8.318, 42.796, -59.938, True),
        (0.0, -13.436, 101.14, -223.73, True))


def anderson_darling(df: DataFrame, features=None, alpha: float = ALPHA) -> DataFrame:
    """A17 from order statistics: Anderson-Darling test of normality, mean and deviation estimated.

    A^2 = -n - 1/n sum (2i - 1) [ln F(z_i) + ln(1 - F(z_(n+1-i)))]. The positions of equal values are L + 1 .. L + c (L values
    below, c equal), so both sums are sums over distinct values with weights from L and c: positions come from bucketed
    counts and prefix sums, and no task sorts a column. Columns: column, n, A2, statistic (with the correction for
    estimated parameters), p-value, normal. Constant columns, and those with fewer than 8 values, have null statistics.
    """
    feats = list(features or numeric_columns(df.schema))
    long = to_long(df, feats)
    off = value_offsets(long, ["column"])
    stats = long.groupBy("column").agg(F.count("value").alias("n"), F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s")).where("n > 0")
    j = off.join(F.broadcast(stats), "column")  # one row for each column
    z = F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))
    low, c, n = F.col("less").cast("double"), F.col("cnt").cast("double"), F.col("n").cast("double")
    up = (low + c) * (low + c) - low * low
    down = c * (2 * n + 1) - ((low + c) * (low + c + 1) - low * (low + 1))
    sums = j.groupBy("column", "n").agg(F.sum(up * log_normal_cdf(z) + down * log_normal_cdf(-z)).alias("_sum"))
    n = F.col("n").cast("double")
    a2 = F.when(F.col("n") >= 8, -n - F.col("_sum") / n)
    out = sums.select("column", "n", a2.alias("A2")).withColumn("statistic", F.col("A2") * (1 + F.lit(0.75) / n + F.lit(2.25) / (n * n)))
    a, p = F.col("statistic"), None
    for bound, c0, c1, c2, upper in AD_P:
        e = F.exp(F.lit(c0) + F.lit(c1) * a + F.lit(c2) * a * a)
        e = 1 - e if upper else F.least(F.lit(1.0), e)
        p = F.when(a >= bound, e) if p is None else p.when(a >= bound, e)
    # The outer exponential turns upwards far out; p is 0 there.
    p = F.when(a > 150, F.lit(0.0)).otherwise(p.when(a < 0, F.lit(1.0)))
    return out.withColumn("p-value", p).withColumn("normal", F.coalesce(F.col("p-value") > alpha, F.lit(False)))


def feature_selection(df: DataFrame, target: str, fixed_exclude, protect, alpha: float = ALPHA,
                      min_group_size: int = 5, high_corr: float | None = None) -> tuple[DataFrame, list[str]]:
    """M1: drop Spearman-insignificant, Kruskal-insignificant (and, optionally, highly correlated)
    features plus the fixed list; never the protected columns; leading columns first.

    The test reports are feature-sized; their names are collected to build the projection.
    """
    from hourcast.operators.clean import drop_existing, lead_columns
    sp = insignificant(spearman_test(df, target, sort=False), "Feature", "P-value", alpha)
    kw = insignificant(kruskal_test(df, target, min_group_size=min_group_size, sort=False), "feature", "p-value", alpha)
    names = [r[0] for r in sp.collect()] + [r[0] for r in kw.collect()]
    if high_corr is not None:
        names += [r[0] for r in high_corr_drop(df, target, threshold=high_corr).collect()]
    names += list(fixed_exclude)
    dropped = [c for c in dict.fromkeys(names) if c in df.columns and c not in protect]
    return lead_columns(drop_existing(df, dropped, protect)), dropped
