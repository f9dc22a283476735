"""Pair correlations by matrix products against pandas, and their plan."""
import math

import numpy as np
import pandas as pd
import pytest

from hourcast.operators import gram
from hourcast.operators import significance as st


def frame(seed=0, n=400, gaps=True):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=n)
    data = {"a": base, "b": base * 3 + rng.normal(size=n), "c": 1e6 + rng.integers(0, 5, n), "d": np.full(n, 7.1), "e": -base,
            "f": rng.integers(0, 3, n).astype(float), "g": rng.normal(size=n), "h": rng.normal(size=n)}
    if gaps:
        data["g"][rng.random(n) < 0.2] = np.nan
        data["h"][rng.random(n) < 0.6] = np.nan
        data["none"] = np.full(n, np.nan)
    return pd.DataFrame(data)


def spark_frame(spark, pdf):
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(5)


def agrees(got, pdf, method):
    want = pdf.corr(method=method)
    constant = {c for c in pdf if pdf[c].nunique() < 2}
    assert len(got) == len(pdf.columns) * (len(pdf.columns) - 1) // 2
    for r in got:
        assert list(pdf.columns).index(r.f1) == r.i1 < r.i2 == list(pdf.columns).index(r.f2)
        w = want.loc[r.f1, r.f2]
        if {r.f1, r.f2} & constant or math.isnan(w):
            assert r.r is None, r
        else:
            assert r.r == pytest.approx(w, abs=1e-9), r


@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("gaps", [True, False])
def test_pairs_equal_pandas(spark, method, gaps):
    pdf = frame(gaps=gaps)
    agrees(st.corr_matrix(spark_frame(spark, pdf), list(pdf.columns), method).collect(), pdf, method)


def test_blocks_of_columns(spark):
    pdf = frame(3)
    agrees(gram.pair_correlations(spark_frame(spark, pdf), list(pdf.columns), block=4).collect(), pdf, "pearson")


def test_small_and_empty_frames(spark):
    empty = spark.createDataFrame([], "a double, b double, c double")
    for method in ("pearson", "spearman"):
        assert [r.r for r in st.corr_matrix(empty, ["a", "b", "c"], method).collect()] == [None] * 3
    assert st.corr_matrix(empty, ["a"]).collect() == []
    one = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert [r.r for r in st.corr_matrix(one, ["a", "b"]).collect()] == [None]


def test_subset_that_is_constant_only_where_the_other_has_values(spark):
    rows = [(123456.7, 1.0 * i) for i in range(20)] + [(1.0 * i, None) for i in range(20)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert st.corr_matrix(df, ["x", "y"]).first().r is None


def test_plan_does_not_grow_with_the_pairs(spark):
    pdf = pd.DataFrame({f"c{i}": np.arange(30.0) * (i + 1) % 17 for i in range(46)})
    df = spark_frame(spark, pdf)
    plan = gram.pair_correlations(df, list(pdf.columns))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("covar") == 0 and len(plan) < 60_000
