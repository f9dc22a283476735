import math


from hourcast.functions.numeric import round_exact, round_scaled
from hourcast.operators import profile
from hourcast.operators import significance as st

CASES = [12.125, 2.675, 2.25, 30.945, 35.065, 70.25, -2.25, -12.125, 0.0, -0.004]


def test_round_exact_is_python_round(spark):
    df = spark.createDataFrame([(x,) for x in CASES + [None, float("nan")]], "x double")
    got = [r[0] for r in df.select(round_exact("x", 2)).collect()]
    assert got == [round(x, 2) for x in CASES] + [None, None]


def test_round_scaled_is_the_array_rule(spark):
    import numpy as np

    df = spark.createDataFrame([(x,) for x in CASES], "x double")
    assert [r[0] for r in df.select(round_scaled("x", 1)).collect()] == [float(v) for v in np.round(CASES, 1)]


NAN = float("nan")


def test_nan_is_missing(spark):
    clean = spark.createDataFrame([(float(i),) for i in range(20)], "x double")
    dirty = clean.union(spark.createDataFrame([(NAN,)] * 5 + [(None,)], "x double"))
    assert profile.describe(clean, ["x"]).collect() == profile.describe(dirty, ["x"]).collect()
    assert profile.histogram(clean, ["x"]).orderBy("bin").collect() == profile.histogram(dirty, ["x"]).orderBy("bin").collect()
    assert profile.outlier_iqr(dirty, ["x"]).first()["Outlier Count"] == 0
    assert profile.negative_columns(spark.createDataFrame([(NAN,), (1.0,)], "x double")).first()["has_negative"] is False


def _frame(spark):
    rows = [(float(i), i * 2.0 + (i * 7919 % 13), None if i % 2 else (i - 30.0) ** 2, NAN if i % 5 == 0 else float(-i * i), None) for i in range(60)]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, d double, e double")


def test_correlations_use_complete_pairs(spark):
    import pandas as pd

    rows, df = _frame(spark)
    want = pd.DataFrame(rows, columns=list("abcde")).astype(float)
    for method in ("pearson", "spearman"):
        m = want[list("abcd")].corr(method=method) if method == "pearson" else pd.DataFrame(
            {y: {x: want[[x, y]].dropna().rank().corr().iloc[0, 1] if x != y else 1.0 for x in "abcd"} for y in "abcd"})
        got = {(r.f1, r.f2): r.r for r in st.corr_matrix(df, list("abcde"), method).collect()}
        assert len(got) == 10
        for (x, y), r in got.items():
            if "e" in (x, y):
                assert r is None
            else:
                assert math.isclose(r, m.loc[x, y], abs_tol=1e-9), (method, x, y)


def test_describe_all(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, None), ("b", 3.0, None), (None, None, None)], "t string, x double, e string")
    got = {r["column"]: r for r in profile.describe_all(df).collect()}
    assert (got["t"]["count"], got["t"]["unique"], got["t"]["top"], got["t"]["freq"]) == (3, 2, "b", 2)
    assert (got["e"]["count"], got["e"]["unique"], got["e"]["top"]) == (0, 0, None)
    assert got["x"]["count"] == 3 and got["x"]["mean"] == 2.0 and got["x"]["top"] is None
