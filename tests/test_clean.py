from pyspark.sql import functions as F

from hourcast.operators import clean


def test_replace_whole_cell_only(spark):
    df = spark.createDataFrame([("-", "a-b"), ("x", "-"), (None, "--")], "a string, b string")
    got = [tuple(r) for r in clean.replace_missing_token(df).collect()]
    assert got == [("Other", "a-b"), ("x", "Other"), (None, "--")]


def test_clamp_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,), (float("nan"),)], "GustSpeed double")
    got = [r[0] for r in clean.clamp_negative(df).collect()]
    assert got[0] == 0.0 and got[1] == 2.0 and got[2] is None and got[3] != got[3]


def test_align_features(spark):
    df = spark.createDataFrame([(1, 2)], "b int, extra int")
    out = clean.align_features(df, ["a", "b"])
    assert out.columns == ["a", "b"] and tuple(out.first()) == (0, 1)


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([("x", 1, 0.5)], "v string, id int, w double")
    rows = {r["column"]: r for r in clean.table_diff(a, b).collect()}
    assert rows["w"]["status"] == "only_right" and rows["id"]["left_position"] == 0
    assert rows["__rows_only_left__"]["n_rows"] == 2 and rows["__rows_only_right__"]["n_rows"] == 0


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "n int, s string")
    rows = {r["column"]: r for r in clean.column_profile(df).collect()}
    assert rows["n"]["kind"] == "numeric" and rows["n"]["n_distinct"] == 2
    assert rows["s"]["non_null"] == 2 and rows["s"]["kind"] == "categorical"


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    out = clean.union_all([a, b])
    assert sorted(out.columns) == ["a", "b", "id"] and out.count() == 2
    assert out.filter(F.col("a").isNull()).count() == 1


def test_lead_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "x int, Temperature int, year int")
    out = clean.lead_columns(clean.drop_existing(df, ["x", "Temperature", "nope"]))
    assert out.columns == ["year", "Temperature"]
