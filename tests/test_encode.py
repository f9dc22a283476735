from pyspark.sql import functions as F

from hourcast.operators import encode


def test_one_hot_unknown_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    other = spark.createDataFrame([("b",), ("z",)], "c string")
    fitted = encode.fit_encoders(train, ["c"])
    out = encode.apply_encoders(other, fitted)
    assert out.columns == ["c_a", "c_b"]
    assert [tuple(r) for r in out.collect()] == [(0.0, 1.0), (0.0, 0.0)]


def test_label_index_sorted_and_unseen(spark):
    vals = [f"v{i:02d}" for i in range(12)]
    train = spark.createDataFrame([(v,) for v in reversed(vals)], "c string")
    other = spark.createDataFrame([("v03",), ("new",)], "c string")
    fitted = encode.fit_encoders(train, ["c"])
    assert [r[0] for r in encode.apply_encoders(other, fitted).collect()] == [3, -1]
    f2 = encode.fit_encoders(train, ["c"], unseen_token=True)
    got = [r[0] for r in encode.apply_encoders(other, f2, unseen_token=True).collect()]
    assert got == [4, 0]  # 'unseen' sorts before 'v..', shifting the others by one


def test_robust_scaler_iqr_zero(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0), (5.0, 5.0)], "a double, k double")
    fitted = encode.fit_robust_scaler(train, ["a", "k"])
    out = encode.apply_robust_scaler(spark.createDataFrame([(3.0, 7.0)], "a double, k double"), fitted).first()
    assert out["a"] == 0.0 and out["k"] == 2.0  # IQR 0 -> x - median


def test_one_hot_rows_sum_to_one(spark):
    df = spark.range(50).select((F.col("id") % 4).cast("string").alias("c"))
    out = encode.apply_encoders(df, encode.fit_encoders(df, ["c"]))
    assert out.select(sum(F.col(c) for c in out.columns).alias("s")).distinct().collect()[0]["s"] == 1.0


def test_label_index_many_shared_prefix_matches_sorted(spark):
    labels = [f"Brand#{i}" for i in range(700)] + ["", "Z", "ä", "Brand"]
    df = spark.createDataFrame([(v,) for v in labels for _ in range(2)], "c string")
    fitted = encode.fit_encoders(df, ["c"])
    got = {r["label"]: r["idx"] for r in fitted.collect()}
    assert got == {v: i for i, v in enumerate(sorted(set(labels)))}
