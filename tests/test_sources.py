import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from hourcast.schema import WEATHER_COLUMNS
from hourcast.sources import html, lake, text

T0 = dt.datetime(2024, 1, 1)


def _tmp():
    return tempfile.mkdtemp(prefix="hourcast-test-")


def test_parse_text_comments_rejects_and_types(spark):
    good = " ".join(["202401010900", "108"] + ["1.5"] * 9 + ["-3.0"] + ["0"] * 12 + ["-"] + ["2"] * 3 + ["-"] + ["7"] * 17)
    assert len(good.split()) == 46
    lines = spark.createDataFrame([("# comment line",), ("   " + good + "  ",), ("202401011000 108 1.0",), ("",)], "value string")
    parsed, rejects = text.parse_observation_lines(lines)
    r = parsed.collect()
    assert len(r) == 1 and rejects.count() == 1
    row = r[0]
    assert row["ObservationTime"] == dt.datetime(2024, 1, 1, 9, 0) and row["StationID"] == "108"
    assert row["Temperature"] == -3.0 and row["WeatherCode"] == "-" and row["hour"] == 9
    assert parsed.columns[:46] == WEATHER_COLUMNS


def test_bad_time_text_is_null_not_error(spark):
    bad = " ".join(["2024XX010900"] + ["1"] * 45)
    parsed, _ = text.parse_observation_lines(spark.createDataFrame([(bad,)], "value string"))
    assert parsed.first()["ObservationTime"] is None


def _obs(spark, hours, value=1.0, station="A"):
    rows = [(station, T0 + dt.timedelta(hours=h), value + h) for h in hours]
    return spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, Temperature double")


def test_lake_scan_prunes_partitions(spark):
    root = os.path.join(_tmp(), "lake")
    lake.write_days(_obs(spark, range(0, 24 * 5)), root)
    df = lake.scan(spark, root, "2024-01-02", "2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters" in plan
    assert df.count() == 48
    assert lake.high_water_mark(spark, root).first()[0] == T0 + dt.timedelta(hours=119)


def test_high_water_mark_empty_lake(spark):
    root = os.path.join(_tmp(), "nothing")
    assert not lake.has_data(spark, root)
    assert lake.high_water_mark(spark, root).first()[0] == dt.datetime(2000, 1, 1)


def test_incremental_merge_keeps_earlier_hours_and_is_idempotent(spark):
    root = os.path.join(_tmp(), "lake")
    lake.incremental_load(spark, _obs(spark, range(0, 30)), root)           # first load: day 1 + 6 h of day 2
    full = _obs(spark, range(0, 48), value=2.0)                              # re-delivery with new values
    lake.incremental_load(spark, full, root, overlap_hours=3)
    d = spark.read.parquet(root)
    assert d.count() == 48                                                   # day 2 hours 0-5 not lost
    again = lake.merge_days(spark, full.filter(F.col("ObservationTime") >= T0 + dt.timedelta(hours=40)), root)
    assert again == 1 and spark.read.parquet(root).count() == 48
    late = _obs(spark, [5], value=100.0)                                     # late row for a written day
    lake.merge_days(spark, late, root)
    v = spark.read.parquet(root).filter(F.col("ObservationTime") == T0 + dt.timedelta(hours=5)).first()
    assert v["Temperature"] == 105.0 and spark.read.parquet(root).count() == 48


def _ranges_loop(start, end, days=30):
    start = start.replace(minute=0, second=0, microsecond=0)
    end = end.replace(minute=0, second=0, microsecond=0)
    out, cur = [], start
    while cur <= end:
        e = min(cur + dt.timedelta(days=days), end).replace(hour=23)
        out.append((cur.strftime("%Y%m%d%H%M"), e.strftime("%Y%m%d%H%M")))
        cur = e + dt.timedelta(hours=1)
    return out


def test_request_ranges_equal_the_loop(spark):
    cases = [(dt.datetime(2024, 1, 1, 5, 30), dt.datetime(2024, 3, 15, 2)), (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
             (dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 2, 1, 0, 0)), (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31, 23))]
    df = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(cases)], "i int, start timestamp_ntz, end timestamp_ntz")
    got = {}
    for r in lake.request_ranges(df).orderBy("i", "k").collect():
        got.setdefault(r["i"], []).append((r["range_start"], r["range_end"]))
    for i, (s, e) in enumerate(cases):
        assert got[i] == _ranges_loop(s, e), i


def test_embedded_weekly_json(spark):
    page = ('<html>x "domesticWeeklyFcastList" :\n [{"aplYmd":"20240105","maxTmpr":"7","minTmpr":"-2","dayString":"금","x":1},'
            '{"aplYmd":"20240106","maxTmpr":"5","minTmpr":"-4","dayString":"토"}], "other":[{"a":1}]</html>')
    df = spark.createDataFrame([(page,), ("<html>none</html>",)], "html string")
    rows = html.weekly_forecast(df).collect()
    assert [(r["day"], r["max_temp"], r["min_temp"], r["day_of_week"]) for r in rows] == [(5, 7.0, -2.0, "Friday"), (6, 5.0, -4.0, "Saturday")]


def test_csv_with_bom(spark):
    d = _tmp()
    with open(os.path.join(d, "data.csv"), "w", encoding="utf-8-sig") as f:
        f.write("날짜,기온,습도\n2022-01-21,2.5,65\n")
    from pyspark.sql import types as T

    from hourcast.sources import files
    schema = T.StructType([T.StructField("날짜", T.StringType()), T.StructField("기온", T.DoubleType()),
                           T.StructField("습도", T.LongType())])
    r = files.read_csv(spark, d, schema).first()
    assert tuple(r) == ("2022-01-21", 2.5, 65)
    back = files.round_trip(files.read_csv(spark, d), os.path.join(d, "rt"))
    assert back.columns == ["날짜", "기온", "습도"]


def test_write_days_bounds_the_files_of_a_day(spark):
    import glob
    root = os.path.join(_tmp(), "lake")
    obs = _obs(spark, range(0, 24 * 3)).repartition(7)
    lake.write_days(obs, root)
    assert all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in glob.glob(f"{root}/year=*/month=*/day=*"))
    lake.write_days(obs, root, rows_per_file=6)
    counts = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{root}/year=*/month=*/day=*")]
    assert all(1 <= n <= 4 for n in counts) and spark.read.parquet(root).count() == 72


def test_merge_reads_only_touched_days(spark, monkeypatch):
    from hourcast import session
    root = os.path.join(_tmp(), "lake")
    lake.write_days(_obs(spark, range(0, 24 * 5)), root)
    plans = []
    cut = session.cut_lineage
    monkeypatch.setattr(session, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    lake.merge_days(spark, _obs(spark, range(30, 40), value=9.0), root)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = [line for p in plans for line in p.split("\n") if "PartitionFilters" in line]
    assert any("20240102" in f for f in filters)
    lake.merge_days(spark, _obs(spark, range(24 * 9, 24 * 9 + 5)), root)  # a new day: nothing to merge with
    assert len(plans) == 1 and spark.read.parquet(root).count() == 125


def test_merge_resolves_duplicates_by_arrival(spark):
    root = os.path.join(_tmp(), "lake")
    rows = [("A", T0, float(v), T0 + dt.timedelta(minutes=m)) for v, m in ((1, 5), (2, 9), (3, 7))]
    df = spark.createDataFrame(rows, "StationID string, ObservationTime timestamp_ntz, Temperature double, landed timestamp_ntz")
    lake.merge_days(spark, df.repartition(3), root, arrival="landed")
    got = spark.read.parquet(root)
    assert [r["Temperature"] for r in got.collect()] == [2.0] and "landed" not in got.columns


def test_newest_run_is_read_whole(spark):
    import time as _t

    from hourcast.sources import files
    root = os.path.join(_tmp(), "fc")
    fc = spark.range(200).selectExpr("2024 AS year", "1 AS month", "CAST(1 + id % 28 AS INT) AS day", "CAST(id % 24 AS INT) AS hour", "CAST(id AS FLOAT) AS pred_Temperature")
    files.write_forecast(fc.limit(5), root, "z_old")
    _t.sleep(1.1)
    files.write_forecast(fc.repartition(4), root, "a_new")
    assert files.latest_forecast(spark, root, by="mtime").count() == 200
    newest = files.latest_forecast(spark, root)
    assert newest.count() == 5 and "run_ts#" in newest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]


def test_checkpoint_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    import pytest

    from hourcast import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
