"""Wave 2 queries: calendar / cyclic / physics features, 24-row difference, back-fill, next hour."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourcast.operators import features, series
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import register, sql_norm

HOURLY = ad.with_ctes("obs_hourly")
WIDE = ad.with_ctes("obs_wide")
KEYS = ["StationID"]

SEASON_SQL = ("CASE WHEN month BETWEEN 3 AND 5 THEN 'Spring' WHEN month BETWEEN 6 AND 8 THEN 'Summer' "
              "WHEN month BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END")
SEGMENT_SQL = ("CASE WHEN hour < 6 THEN 'Dawn' WHEN hour < 12 THEN 'Morning' WHEN hour < 18 THEN 'Afternoon' "
               "WHEN hour < 22 THEN 'Evening' ELSE 'Night' END")


@register("season_segment", oracle=sql_norm(
    f"""SELECT StationID, ObservationTime, {SEASON_SQL} AS season, {SEGMENT_SQL} AS time_segment,
       CAST(isodow(ObservationTime) - 1 AS BIGINT) AS weekday FROM obs_hourly""",
    ts=["ObservationTime"], with_=HOURLY))
def q_season_segment(spark, sf_dir):
    from hourcast.functions import timefeat as tf
    h = ad.obs_hourly(spark, sf_dir)
    return h.select("StationID", "ObservationTime", tf.season("month").alias("season"),
                    tf.time_segment("hour").alias("time_segment"),
                    tf.weekday_index("ObservationTime").alias("weekday"))


@register("cyclic_time", oracle=sql_norm(
    """SELECT StationID, ObservationTime,
       sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
       sin(2 * pi() * (month - 1) / 12) AS month_sin, cos(2 * pi() * (month - 1) / 12) AS month_cos,
       sin(2 * pi() * (day - 1) / 31) AS day_sin, cos(2 * pi() * (day - 1) / 31) AS day_cos,
       sin(2 * pi() * (isodow(ObservationTime) - 1) / 7) AS weekday_sin, cos(2 * pi() * (isodow(ObservationTime) - 1) / 7) AS weekday_cos
FROM obs_hourly""",
    doubles=["hour_sin", "hour_cos", "month_sin", "month_cos", "day_sin", "day_cos", "weekday_sin", "weekday_cos"],
    ts=["ObservationTime"], with_=HOURLY))
def q_cyclic_time(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir)
    out = features.add_calendar_features(h, with_weekday=True)
    return out.select("StationID", "ObservationTime", "hour_sin", "hour_cos", "month_sin", "month_cos",
                      "day_sin", "day_cos", "weekday_sin", "weekday_cos")


@register("derived_physics", oracle=sql_norm(
    """SELECT event_id, SolarRadiation * sin(pi() / 24 * hour) AS solar_effect,
       SoilTemperature5cm - GroundTemperature AS soil_temp_diff,
       VaporPressure / (RelativeHumidity + 0.001) AS vapor_ratio,
       SeaLevelPressure - LocalPressure AS pressure_diff FROM obs_wide""",
    doubles=["solar_effect", "soil_temp_diff", "vapor_ratio", "pressure_diff"], ints=["event_id"], with_=WIDE))
def q_derived_physics(spark, sf_dir):
    w = ad.obs_wide(spark, sf_dir)
    return features.add_physics_features(w).select("event_id", "solar_effect", "soil_temp_diff", "vapor_ratio", "pressure_diff")


@register("series_position", oracle=sql_norm(
    """SELECT StationID, ObservationTime, row_number() OVER (PARTITION BY StationID ORDER BY ObservationTime) AS pos
FROM obs_hourly""", ints=["pos"], ts=["ObservationTime"], with_=HOURLY))
def q_series_position(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir)
    return series.ordinal(h, KEYS, "ObservationTime").select("StationID", "ObservationTime", "pos")


@register("diff_24", oracle=sql_norm(
    """SELECT a.StationID, a.ObservationTime, a.Temperature,
       a.Temperature - lag(a.Temperature, 24) OVER (PARTITION BY a.StationID ORDER BY a.ObservationTime) AS diff24_pos,
       a.Temperature - b.Temperature AS diff24_time
FROM obs_hourly a LEFT JOIN obs_hourly b
  ON a.StationID = b.StationID AND b.ObservationTime = a.ObservationTime - INTERVAL 24 HOUR""",
    doubles=["Temperature", "diff24_pos", "diff24_time"], ts=["ObservationTime"], with_=HOURLY))
def q_diff_24(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir).select("StationID", "ObservationTime", "Temperature")
    p = series.ordinal(h, KEYS, "ObservationTime")
    p = series.diff_by_position(p, KEYS, "pos", "Temperature", 24, "diff24_pos")
    p = series.diff_by_time(p, KEYS, "ObservationTime", "Temperature", 24, "diff24_time")
    return p.drop("pos")


@register("backfill", oracle=sql_norm(
    """SELECT StationID, ObservationTime,
       first_value(d IGNORE NULLS) OVER (PARTITION BY StationID ORDER BY ObservationTime
                                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS diff24_filled
FROM (SELECT StationID, ObservationTime,
             Temperature - lag(Temperature, 24) OVER (PARTITION BY StationID ORDER BY ObservationTime) AS d
      FROM obs_hourly)""",
    doubles=["diff24_filled"], ts=["ObservationTime"], with_=HOURLY))
def q_backfill(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir).select("StationID", "ObservationTime", "Temperature")
    p = series.ordinal(h, KEYS, "ObservationTime")
    p = series.diff_by_position(p, KEYS, "pos", "Temperature", 24, "diff24_filled")
    return series.backfill(p, KEYS, "ObservationTime", ["diff24_filled"]).select(
        "StationID", "ObservationTime", "diff24_filled")


@register("backfill_sparse", oracle=sql_norm(
    """SELECT StationID, ObservationTime,
       first_value(GustTime IGNORE NULLS) OVER (PARTITION BY StationID ORDER BY ObservationTime, event_id
                                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS GustTime
FROM obs_wide""",
    doubles=["GustTime"], ts=["ObservationTime"], with_=WIDE))
def q_backfill_sparse(spark, sf_dir):
    """W2 on raw observations where nulls are scattered (10 % of GustTime), not only leading."""
    w = ad.obs_wide(spark, sf_dir).select("StationID", "ObservationTime", "GustTime", "event_id")
    return series.backfill(w, KEYS, "ObservationTime", ["GustTime"], tiebreak=["event_id"]).drop("event_id")


@register("next_hour_pair", oracle=sql_norm(
    """SELECT a.StationID, a.ObservationTime, a.Temperature,
       lead(a.Temperature, 1) OVER (PARTITION BY a.StationID ORDER BY a.ObservationTime) AS next_row_temp,
       b.Temperature AS next_hour_temp
FROM obs_hourly a LEFT JOIN obs_hourly b
  ON a.StationID = b.StationID AND b.ObservationTime = a.ObservationTime + INTERVAL 1 HOUR""",
    doubles=["Temperature", "next_row_temp", "next_hour_temp"], ts=["ObservationTime"], with_=HOURLY))
def q_next_hour_pair(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir).select("StationID", "ObservationTime", "Temperature")
    p = series.ordinal(h, KEYS, "ObservationTime")
    p = series.next_value_by_position(p, KEYS, "pos", ["Temperature"], 1).withColumnRenamed("Temperature_next1", "next_row_temp")
    p = series.next_value_by_time(p, KEYS, "ObservationTime", ["Temperature"], 1).withColumnRenamed("Temperature_next1h", "next_hour_temp")
    return p.drop("pos")


@register("add_features", oracle=sql_norm(
    f"""SELECT StationID, ObservationTime, {SEASON_SQL} AS season, {SEGMENT_SQL} AS time_segment,
       sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * (month - 1) / 12) AS month_cos,
       first_value(d IGNORE NULLS) OVER (PARTITION BY StationID ORDER BY ObservationTime
                                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS Temperature_diff24
FROM (SELECT *, Temperature - lag(Temperature, 24) OVER (PARTITION BY StationID ORDER BY ObservationTime) AS d FROM obs_hourly)""",
    doubles=["hour_sin", "month_cos", "Temperature_diff24"], ts=["ObservationTime"], with_=HOURLY))
def q_add_features(spark, sf_dir):
    """M3 (extended) on the hourly series: calendar, cyclic, 24-row difference, back-fill."""
    h = ad.obs_hourly(spark, sf_dir)
    # physics inputs are absent in the hourly series: add them as nulls so the notebook variant runs
    for c in ["SolarRadiation", "SoilTemperature5cm", "GroundTemperature", "VaporPressure",
              "RelativeHumidity", "SeaLevelPressure", "LocalPressure"]:
        h = h.withColumn(c, F.lit(None).cast("double"))
    out = features.add_features(h, extended=True)
    return out.select("StationID", "ObservationTime", "season", "time_segment", "hour_sin", "month_cos",
                      "Temperature_diff24")
