import math

import pytest
from pyspark.sql import functions as F

from hourcast.functions import advice as adv
from hourcast.operators import advise


def test_band_edges(spark):
    vals = [4.99, 5.0, 5.01, 10.0, 10.5, 20.0, 20.01, 28.0, 28.01, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "t double")
    got = [r[0] for r in df.select(adv.temp_band(F.col("t"))).collect()]
    assert got == ["5도 이하", "5도 이하", "10도 이하", "10도 이하", "20도 이하", "20도 이하", "28도 이하",
                   "28도 이하", "28도 초과", "28도 초과", "28도 초과"]


def test_layering_edges(spark):
    df = spark.createDataFrame([(6.99,), (7.0,), (9.99,), (10.0,), (None,)], "r double")
    got = [r[0] for r in df.select(adv.layering_tip(F.col("r"))).collect()]
    assert got[0] == "" and got[4] == ""
    assert got[1] == got[2] == adv.LAYERING_TIPS[1][1]
    assert got[3] == adv.LAYERING_TIPS[0][1]


def test_clothing_sentence_matches_python_rule(spark):
    def rule(temp, s):
        adj = temp - 2 if s == "cold" else temp + 2 if s == "hot" else temp
        for lim, txt in adv.CLOTH_SENSE_RULES:
            if lim is None or adj >= lim:
                return f"예상 기온({temp:.1f}°C: {txt}"
    cases = [(t, s) for t in [24.95, 0.25, 0.35, 2.675, 10.0, 15.0, 20.0, 25.0, -3.0, 12.05]
             for s in ["cold", "normal", "hot"]]
    df = spark.createDataFrame(cases, "t double, s string")
    got = [r[0] for r in df.select(adv.clothing_sentence(F.col("t"), F.col("s"))).collect()]
    assert got == [rule(t, s) for t, s in cases]


def test_extreme_hours_first_on_ties(spark):
    rows = [("A", "2024-01-01", h, t) for h, t in [(0, 3.0), (6, 9.0), (12, 9.0), (18, 1.0), (22, 1.0)]]
    df = spark.createDataFrame(rows, "StationID string, date string, hour int, pred_Temperature double")
    r = advise.extreme_hours(df).collect()[0]
    assert (r["max_hour"], r["min_hour"]) == (6, 18)


def test_daily_advice_literal(spark):
    rows = [("A", "2024-01-01", h, t) for h, t in enumerate([0.0, 10.0, 5.0])]
    df = spark.createDataFrame(rows, "StationID string, date string, hour int, pred_Temperature double")
    r = advise.daily_advice(df).collect()[0]
    assert r["avg_temp"] == 5.0 and r["temp_difference"] == 10.0
    assert r["band"] == "5도 이하" and r["layering_tip"] == adv.LAYERING_TIPS[0][1]
    assert r["activity_tip"] == adv.STYLE_RECOMMENDATIONS["5도 이하"]["activity_tip"]


def test_adjusted_summary_shift_and_units(spark):
    rows = [("A", "2024-01-01", 0, 10.0), ("A", "2024-01-01", 1, 20.0)]
    df = spark.createDataFrame(rows, "StationID string, date string, hour int, pred_Temperature double")
    r = advise.adjusted_summary(df, "매우 더위 탐", "F").collect()[0]
    assert math.isclose(r["avg_display"], (15.0 - 3.0) * 9 / 5 + 32)
    assert r["range_c"] == 10.0


def test_band_dimension_is_fixed_size(spark):
    dim = adv.band_dimension(spark)
    n = sum(len(c) for b in adv.STYLE_RECOMMENDATIONS.values() for c in b["items"].values())
    assert dim.count() == n
    assert dim.select("band").distinct().count() == 5


@pytest.mark.parametrize("name,expected", [("run-007", "run-008"), ("a-9", "a-010"), ("m-1-1", "m-002-002"), ("x-y", None)])
def test_increment_suffix(spark, name, expected):
    from hourcast.functions.text import increment_suffix
    got = spark.createDataFrame([(name,)], "n string").select(increment_suffix(F.col("n"))).first()[0]
    assert got == expected


def test_season_and_segment_edges(spark):
    from hourcast.functions import timefeat as tf
    months = spark.createDataFrame([(m,) for m in [1, 2, 3, 5, 6, 8, 9, 11, 12]], "month int")
    assert [r[0] for r in months.select(tf.season("month")).collect()] == [
        "Winter", "Winter", "Spring", "Spring", "Summer", "Summer", "Fall", "Fall", "Winter"]
    hours = spark.createDataFrame([(h,) for h in [0, 5, 6, 11, 12, 17, 18, 21, 22, 23]], "hour int")
    assert [r[0] for r in hours.select(tf.time_segment("hour")).collect()] == [
        "Dawn", "Dawn", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night"]


def test_weekday_monday_zero_and_names(spark):
    import datetime as dt

    from hourcast.functions import timefeat as tf
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1 + i),) for i in range(7)], "t timestamp_ntz")
    rows = df.select(tf.weekday_index("t"), tf.weekday_name("t")).collect()
    assert [r[0] for r in rows] == list(range(7)) and rows[0][1] == "Monday" and rows[6][1] == "Sunday"


def test_advice_json_is_stable_across_partitionings(spark):
    from hourcast.functions import advice as adv
    from hourcast.operators import advise
    from hourcast.plans import q_advice
    from tests.conftest import SF_SMALL

    def made():
        rows = advise.advice_json(advise.daily_advice(q_advice._fc(spark, SF_SMALL)), adv.band_dimension(spark))
        return sorted(r["advice_json"] for r in rows.collect())

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        a = made()
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        b = made()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b and len(a) > 0
