import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.functions import pvalues as pv
from hourcast.operators import profile, ranks
from hourcast.operators import significance as st


def _avg_rank(values):
    order = sorted(values)
    return {v: order.index(v) + (order.count(v) + 1) / 2 for v in set(values)}


def test_average_ranks_with_ties(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 10.0, 2.0]
    df = spark.createDataFrame([("c", v) for v in vals], "column string, value double")
    got = {r["value"]: r["rank"] for r in ranks.average_ranks(df, ["column"], n_buckets=3).collect()}
    assert got == _avg_rank(vals)
    assert sum(got[v] for v in vals) == len(vals) * (len(vals) + 1) / 2


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.exponential(5, 501), 1)
    df = spark.createDataFrame([("c", float(v)) for v in vals], "column string, value double")
    got = {r["p"]: r["q"] for r in ranks.exact_quantiles(df, ["column"], [0.25, 0.5, 0.75, 0.9], n_buckets=8).collect()}
    for p, q in got.items():
        assert math.isclose(q, float(np.percentile(vals, p * 100)), rel_tol=1e-12)


def test_describe_edge_frames(spark):
    df = spark.createDataFrame([(1.0, None, 5.0)], "a double, allnull double, const double")
    rows = {r["column"]: r for r in profile.describe(df).collect()}
    assert rows["a"]["count"] == 1 and rows["a"]["std"] is None and rows["a"]["p50"] == 1.0
    assert rows["allnull"]["count"] == 0 and rows["allnull"]["mean"] is None
    empty = spark.createDataFrame([], "a double")
    assert profile.describe(empty).collect()[0]["count"] == 0


def test_iqr_zero_and_outliers(spark):
    vals = [1.0] * 10 + [5.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = profile.outlier_iqr(df).collect()[0]
    assert r["Outlier Count"] == 1 and r["Outlier Ratio (%)"] == round(100 / 11, 3)


def test_spearman_constant_and_perfect(spark):
    rows = [(float(i), float(i * i), 7.0) for i in range(20)]
    df = spark.createDataFrame(rows, "y double, sq double, const double")
    out = {r["Feature"]: r for r in st.spearman_test(df, "y").collect()}
    assert math.isclose(out["sq"]["Correlation"], 1.0) and out["sq"]["P-value"] < 1e-100
    assert out["const"]["Correlation"] is None
    assert st.insignificant(st.spearman_test(df, "y"), "Feature", "P-value").count() == 0


def test_rank_columns_keeps_rows_and_looks_up_hot_values(spark):
    """Frequent values by look-up, rare ones by a join, gaps stay gaps; a hot value makes no row exchange by its value."""
    rng = np.random.default_rng(5)
    rows = [(float(rng.integers(0, 4)), float(v) if i % 3 else 0.0, None if i % 7 == 0 else float(i % 5), float(i)) for i, v in enumerate(rng.permutation(400))]
    df = spark.createDataFrame(rows, "few double, mixed double, holed double, id double")
    got = [tuple(r) for r in st.rank_columns(df, df.columns, most=20).collect()]
    ranks_of = [_avg_rank([r[c] for r in rows if r[c] is not None]) for c in range(4)]
    want = [tuple(None if r[c] is None else ranks_of[c][r[c]] for c in range(4)) for r in rows]
    assert sorted(got, key=lambda r: r[3]) == sorted(want, key=lambda r: r[3])
    plan = st.rank_columns(df, ["few", "holed"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_outliers_read_the_frame_once(spark):
    """Quartiles and counts come from counted cells: what is left after them scans none of the rows."""
    df = spark.createDataFrame([(float(i % 10), float(i) if i else 1e6) for i in range(200)] + [(None, None)], "a double, b double")
    out = profile.outlier_iqr(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert {r["Column"]: (r["Outlier Count"], r["Outlier Ratio (%)"]) for r in out.collect()} == {"a": (0, 0.0), "b": (1, round(100 / 201, 3))}


def test_pvalue_tails_known_values():
    assert math.isclose(pv.t_two_sided(2.228138851986, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(pv.chi2_sf(3.841458820694, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(pv.chi2_sf(5.0, 2), math.exp(-2.5), rel_tol=1e-12)
    assert math.isclose(pv.t_two_sided(1.0, 1), 0.5, rel_tol=1e-12)  # Cauchy: P(|T| > 1) = 1/2


def test_kruskal_matches_formula(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.integers(0, 8, 9), "b": rng.integers(2, 10, 7), "c": rng.integers(0, 5, 6), "tiny": [1, 2]}
    rows = [(float(v), g) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "y double, g string")
    got = st.kruskal_test(df, "y", ["g"]).collect()[0]
    kept = [(float(v), g) for g, vs in groups.items() if len(vs) >= 5 for v in vs]
    vals = [v for v, _ in kept]
    rk = _avg_rank(vals)
    n = len(vals)
    s = sum(sum(rk[v] for v, gg in kept if gg == g) ** 2 / sum(1 for _, gg in kept if gg == g) for g in ("a", "b", "c"))
    ties = sum(vals.count(v) ** 3 - vals.count(v) for v in set(vals))
    h = (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (n ** 3 - n))
    assert math.isclose(got["H-statistic"], h, rel_tol=1e-9) and got["k"] == 3
    assert math.isclose(got["p-value"], pv.chi2_sf(h, 2), rel_tol=1e-9)


def test_jarque_bera(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 9.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = st.normality_test(df).collect()[0]
    x = np.array(vals)
    m = x.mean()
    m2, m3, m4 = ((x - m) ** 2).mean(), ((x - m) ** 3).mean(), ((x - m) ** 4).mean()
    jb = len(x) / 6 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4)
    assert math.isclose(r["JB"], jb, rel_tol=1e-9) and math.isclose(r["p-value"], math.exp(-jb / 2), rel_tol=1e-9)


def test_high_corr_drop_keeps_closer_to_target(spark):
    rows = [(float(i), float(i) + (1.5 if i % 5 == 0 else 0.0), float(2 * i + 1), float((i * 7) % 11)) for i in range(40)]
    df = spark.createDataFrame(rows, "y double, a double, b double, noise double")
    dropped = {r[0] for r in st.high_corr_drop(df, "y", ["a", "b", "noise"], 0.95, "spearman").collect()}
    assert dropped == {"a"}  # b has |rho| = 1 with y, a is slightly less


@pytest.mark.parametrize("bins", [3, 30])
def test_histogram_counts(spark, bins):
    vals = [0.0, 1.0, 2.0, 2.5, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = profile.histogram(df, bins=bins).collect()
    assert sum(r["count"] for r in h) == len(vals)
    edges = np.histogram(vals, bins=bins)[0]
    assert sorted((r["bin"], r["count"]) for r in h) == [(i + 1, int(c)) for i, c in enumerate(edges) if c]


def test_anderson_darling_equals_the_direct_sum(spark):
    import math
    import random
    rng = random.Random(4)
    cols = {"normal": [rng.gauss(5, 2) for _ in range(300)], "ties": [float(round(rng.gauss(0, 2))) for _ in range(300)],
            "skewed": [rng.expovariate(1) for _ in range(300)], "far": [rng.gauss(0, 1) for _ in range(299)] + [60.0], "constant": [3.0] * 300}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(4)
    got = {r["column"]: r for r in st.anderson_darling(df, list(cols)).collect()}

    def tail(z):  # ln P(Z <= z); asymptotic where erfc is 0
        p = 0.5 * math.erfc(-z / math.sqrt(2))
        return math.log(p) if p > 0 else -z * z / 2 - math.log(-z * math.sqrt(2 * math.pi))

    for c, v in cols.items():
        if c == "constant":
            assert got[c]["A2"] is None and got[c]["p-value"] is None and not got[c]["normal"]
            continue
        n, m = len(v), sum(v) / len(v)
        s = math.sqrt(sum((x - m) ** 2 for x in v) / (n - 1))
        z = sorted((x - m) / s for x in v)
        a2 = -n - sum((2 * i + 1) * (tail(z[i]) + tail(-z[n - 1 - i])) for i in range(n)) / n
        assert got[c]["A2"] == pytest.approx(a2, rel=1e-8, abs=1e-8)
        assert 0 <= got[c]["p-value"] <= 1
    assert got["normal"]["normal"] and not got["skewed"]["normal"] and not got["far"]["normal"]
    short = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert st.anderson_darling(short).first()["A2"] is None
    assert st.anderson_darling(short.where("x is null")).collect() == []


def test_log_normal_cdf_in_the_tails(spark):
    import math
    zs = [-60.0, -30.0, -8.0, -7.0710678, -7.0710679, -3.0, -1e-9, 0.0, 1.0, 5.0, 9.0, 40.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double").select("z", st.log_normal_cdf(F.col("z")).alias("l"))
    for r in df.collect():
        p = 0.5 * math.erfc(-r.z / math.sqrt(2))
        want = math.log(p) if p > 0 else -r.z ** 2 / 2 - math.log(-r.z * math.sqrt(2 * math.pi)) - 1 / r.z ** 2
        assert r.l == pytest.approx(want, rel=1e-7, abs=1e-15)
