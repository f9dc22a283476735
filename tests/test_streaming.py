import datetime as dt
import os
import tempfile

from hourcast.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def test_stream_ingest_rerun_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="hourcast-stream-")
    rows = [("A", T0 + dt.timedelta(hours=h), float(h)) for h in range(60)]
    df = spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, Temperature double")
    df.write.mode("append").parquet(os.path.join(base, "landing"))
    df.filter("Temperature > 30").write.mode("append").parquet(os.path.join(base, "landing"))  # re-sent rows
    args = (os.path.join(base, "landing"), df.schema, os.path.join(base, "lake"), os.path.join(base, "ckpt"))
    jobs.ingest_stream(spark, *args)
    assert spark.read.parquet(args[2]).count() == 60
    jobs.ingest_stream(spark, *args)  # nothing new landed
    assert spark.read.parquet(args[2]).count() == 60


def test_stream_daily_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="hourcast-stream-")
    rows = [("A" if h % 2 else "B", T0 + dt.timedelta(hours=h), float(h % 13)) for h in range(100)]
    df = spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, Temperature double")
    df.write.mode("append").parquet(os.path.join(base, "landing"))
    jobs.daily_summary_stream(spark, os.path.join(base, "landing"), df.schema, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    got = {(r["StationID"], str(r["obs_date"])): (r["n"], r["min_value"], r["max_value"])
           for r in jobs.read_daily_summary(spark, os.path.join(base, "out")).collect()}
    exp = {}
    for st, t, v in rows:
        k = (st, str(t.date()))
        n, lo, hi = exp.get(k, (0, v, v))
        exp[k] = (n + 1, min(lo, v), max(hi, v))
    assert got == exp


def test_stream_ingest_lands_late_and_corrected_rows(spark):
    base = tempfile.mkdtemp(prefix="hourcast-stream-")
    schema = "StationID string, ObservationTime timestamp_ntz, Temperature double"
    args = None
    for shift, value in ((48, 1.0), (0, 2.0), (48, 3.0)):  # a day, then rows two days older, then the first day again
        df = spark.createDataFrame([("A", T0 + dt.timedelta(hours=shift + h), value) for h in range(24)], schema)
        df.write.mode("append").parquet(os.path.join(base, "landing"))
        args = args or (os.path.join(base, "landing"), df.schema, os.path.join(base, "lake"), os.path.join(base, "ckpt"))
        jobs.ingest_stream(spark, *args)
    got = spark.read.parquet(args[2]).groupBy("day").count().orderBy("day").collect()
    assert [(r["day"], r["count"]) for r in got] == [(1, 24), (3, 24)]
    assert spark.read.parquet(args[2]).where("day = 3 and Temperature = 3").count() == 24  # the later delivery wins


def test_stream_daily_counts_late_rows(spark):
    base = tempfile.mkdtemp(prefix="hourcast-stream-")
    schema = "StationID string, ObservationTime timestamp_ntz, Temperature double"
    for hours in (range(240, 260), range(0, 10)):
        df = spark.createDataFrame([("A", T0 + dt.timedelta(hours=h), float(h)) for h in hours], schema)
        df.write.mode("append").parquet(os.path.join(base, "landing"))
        jobs.daily_summary_stream(spark, os.path.join(base, "landing"), df.schema, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    got = {str(r["obs_date"]): (r["n"], r["mean_value"]) for r in jobs.read_daily_summary(spark, os.path.join(base, "out")).collect()}
    assert got == {"2024-01-01": (10, 4.5), "2024-01-11": (20, 249.5)}


SCHEMA = "StationID string, ObservationTime timestamp_ntz, Temperature double"


def _landing(spark, name):
    base = tempfile.mkdtemp(prefix=f"hourcast-{name}-")

    def land(hours, value=None):
        df = spark.createDataFrame([("A", T0 + dt.timedelta(hours=h), float(h) if value is None else value) for h in hours], SCHEMA)
        df.write.mode("append").parquet(os.path.join(base, "landing"))

    schema = spark.createDataFrame([], SCHEMA).schema
    return land, (os.path.join(base, "landing"), schema, os.path.join(base, "out"), os.path.join(base, "ckpt"))


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def test_replayed_landing_touches_no_day(spark):
    land, args = _landing(spark, "resent")
    land(range(60))
    jobs.ingest_stream(spark, *args, drop_resent="7 days")
    before = _files(args[2])
    land(range(60))  # the same rows again
    jobs.ingest_stream(spark, *args, drop_resent="7 days")
    assert _files(args[2]) == before
    land(range(24, 30), value=-1.0)  # a correction of the second day, and a late day before all others
    land(range(-24, -20))
    jobs.ingest_stream(spark, *args, drop_resent="7 days")
    after = _files(args[2])
    same = {f for f in before if "/day=2/" not in f}
    assert all(after.get(f) == before[f] for f in same) and any("/day=31/" in f for f in after)
    assert spark.read.parquet(args[2]).where("Temperature = -1").count() == 6 and spark.read.parquet(args[2]).count() == 64


def test_windows_are_emitted_once_and_late_rows_are_dropped(spark):
    land, args = _landing(spark, "windows")
    read = lambda: {str(r["obs_date"]): (r["n"], r["mean_value"]) for r in spark.read.parquet(args[2]).collect()}
    land([*range(20), *range(24, 48), *range(48, 60)])
    jobs.daily_windows_stream(spark, *args)  # the newest row is 2024-01-03 11:00, so the watermark stands at 2024-01-02 11:00
    assert read() == {"2024-01-01": (20, 9.5)}
    land([20, 21, 47, 58])  # too late for the first day, in time for the others
    land(range(96, 100))
    jobs.daily_windows_stream(spark, *args)
    assert read() == {"2024-01-01": (20, 9.5), "2024-01-02": (25, (sum(range(24, 48)) + 47) / 25), "2024-01-03": (13, (sum(range(48, 60)) + 58) / 13)}
    jobs.daily_windows_stream(spark, *args)  # nothing has landed
    assert spark.read.parquet(args[2]).count() == 3


def test_windows_do_not_depend_on_the_session_zone(spark):
    land, args = _landing(spark, "zone")
    land(range(72))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        jobs.daily_windows_stream(spark, *args)
        assert sorted((str(r["obs_date"]), r["n"]) for r in spark.read.parquet(args[2]).collect()) == [("2024-01-01", 24)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
