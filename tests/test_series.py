import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from hourcast.operators import series, split

T0 = dt.datetime(2024, 1, 1)


def _series(spark, hours_by_station):
    rows = []
    for st, hours in hours_by_station.items():
        for h in hours:
            rows.append((st, T0 + dt.timedelta(hours=h), float(h * 1.5 + (3 if st == "B" else 0))))
    return spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, Temperature double")


def test_ordinal_equals_row_number(spark):
    df = _series(spark, {"A": [h for h in range(80) if h % 7 != 3], "B": list(range(30))})
    got = series.ordinal(df, ["StationID"], "ObservationTime")
    w = Window.partitionBy("StationID").orderBy("ObservationTime")
    ref = df.withColumn("rn", F.row_number().over(w))
    j = got.join(ref, ["StationID", "ObservationTime"])
    assert j.filter(F.col("pos") != F.col("rn")).count() == 0 and j.count() == df.count()


def test_diff_position_vs_time_with_missing_hour(spark):
    hours = [h for h in range(30) if h != 2]  # hour 2 missing
    df = series.ordinal(_series(spark, {"A": hours}), ["StationID"], "ObservationTime")
    p = series.diff_by_position(df, ["StationID"], "pos", "Temperature", 24, "dp")
    p = series.diff_by_time(p, ["StationID"], "ObservationTime", "Temperature", 24, "dt")
    r = {row["ObservationTime"].hour + 24 * (row["ObservationTime"].day - 1): row for row in p.collect()}
    assert r[26]["dt"] is None           # 24 h earlier (hour 2) is missing
    assert r[27]["dp"] == 27 * 1.5 - 3 * 1.5  # by position: 24 rows back is hour 3
    assert r[27]["dt"] == 24 * 1.5


def test_backfill_across_buckets(spark):
    rows = [("A", T0 + dt.timedelta(hours=h), None if h < 50 or h in (60, 61) else float(h)) for h in range(72)]
    df = spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, v double")
    out = {r["ObservationTime"]: r["v"] for r in series.backfill(df, ["StationID"], "ObservationTime", ["v"]).collect()}
    assert out[T0] == 50.0 and out[T0 + dt.timedelta(hours=60)] == 62.0


def test_backfill_reads_each_row_once_and_orders_ties(spark):
    """60,000 rows of one day (a frame to the bucket's end takes their square), six at each time, in the tiebreak's order."""
    n = 60_000
    rows = spark.range(n).select(F.lit("A").alias("k"), "id", (F.lit(T0) + F.make_dt_interval(secs=(F.col("id") / 6).cast("int"))).cast("timestamp_ntz").alias("t"),
                                 F.when(F.col("id") % 4 == 3, F.col("id").cast("double")).alias("v"))
    out = series.backfill(rows.orderBy(F.desc("id")), ["k"], "t", ["v"], tiebreak=["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing" not in plan.lower()
    assert out.where(F.col("v") != F.col("id") - F.col("id") % 4 + 3).count() == 0 and out.where("v is null").count() == 0


def test_sliding_samples_count_and_content(spark):
    n, L, H = 60, 7, 4
    df = _series(spark, {"A": list(range(n)), "B": list(range(n // 2))})
    s = split.sliding_samples(df, ["StationID"], "ObservationTime", ["Temperature"], "Temperature",
                              seq_len=L, horizon=H, block_rows=L + H + 1, dtype="double")
    counts = {r["StationID"]: r["count"] for r in s.groupBy("StationID").count().collect()}
    assert counts == {"A": n - L - H + 1, "B": n // 2 - L - H + 1}
    for r in s.filter("StationID = 'A'").collect():
        start = r["start_pos"] - 1
        assert [x[0] for x in r["x"]] == [h * 1.5 for h in range(start, start + L)]
        assert r["y"] == [h * 1.5 for h in range(start + L, start + L + H)]


def test_tail_split_invariants(spark):
    df = _series(spark, {"A": list(range(700)), "B": list(range(400))})
    t = split.tail_split(df, ["StationID"], "ObservationTime", 336, 168)
    assert t.filter(F.col("in_train") == F.col("in_val")).count() == 0  # disjoint and covering
    a = t.filter("StationID = 'A'")
    assert a.filter("in_val").count() == 504 and a.filter("in_latest").count() == 336
    assert a.filter("in_latest AND NOT in_val").count() == 0


def test_holdout_split(spark):
    df = _series(spark, {"A": list(range(124))})
    s = {r["split"]: r["count"] for r in split.holdout_split(df, ["StationID"], "ObservationTime").groupBy("split").count().collect()}
    assert s == {"test": 24, "train": 80, "val": 20}
