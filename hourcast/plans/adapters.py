"""Adapters from the driver tables to the observation / forecast shapes the operators expect.

The test data has no weather tables, so (SURVEY 7.1):

* ``events`` stands for raw observations: ObservationTime = ts, StationID = user_id % 4,
  Temperature = value, WeatherCode = event_type, props = JSON source;
* ``obs_hourly`` is the hourly series per station (mean of the events in the hour);
* ``forecast`` is that series renamed to ``pred_Temperature`` on a temperature-like scale;
* ``lineitem`` / ``orders`` / ``part`` / ``customer`` are wide numeric / categorical tables.

Every adapter is a lazy projection or aggregation over the given parquet, so all work grows with
the input. Each has a DuckDB twin in ``SQL_CTES`` that oracles reuse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions import timefeat as tf
from hourcast.session import table_path

N_STATIONS = 4
# Forecast scale: pred_Temperature = avg(value) * FORECAST_SCALE + FORECAST_SHIFT.
FORECAST_SCALE = 0.4
FORECAST_SHIFT = -10.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def obs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event (10,000 rows at sf0.01; ``ts`` unique)."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("ts").alias("ObservationTime"),
        (F.col("user_id") % N_STATIONS).cast("string").alias("StationID"),
        F.col("value").alias("Temperature"),
        F.col("event_type").alias("WeatherCode"),
        F.col("props"),
    ).withColumns(tf.time_parts("ObservationTime"))


def obs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly series per station: mean value of the hour and event count."""
    e = read(spark, sf_dir, "events")
    hourly = (e.groupBy((F.col("user_id") % N_STATIONS).cast("string").alias("StationID"),
                        tf.hour_floor("ts").alias("ObservationTime"))
              .agg(F.avg("value").alias("Temperature"), F.count(F.lit(1)).alias("n_events")))
    return hourly.withColumns(tf.time_parts("ObservationTime"))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast-shaped table (year, month, day, hour, day_of_week, pred_Temperature) per station."""
    h = obs_hourly(spark, sf_dir)
    return h.select(
        "StationID", "year", "month", "day", "hour",
        tf.weekday_name("ObservationTime").alias("day_of_week"),
        (F.col("Temperature") * F.lit(FORECAST_SCALE) + F.lit(FORECAST_SHIFT)).alias("pred_Temperature"),
    )


def with_forecast_time(fc: DataFrame) -> DataFrame:
    """S13 post-processing: add ``datetime`` and ``date`` from the parts."""
    dt = tf.from_parts("year", "month", "day", "hour")
    return fc.withColumn("datetime", dt).withColumn("date", F.to_date(F.col("datetime")))


# DuckDB twins of the adapters, as WITH-clause bodies for oracle SQL.
SQL_CTES = {
    "obs_events": f"""obs_events AS (
  SELECT event_id, ts AS ObservationTime, CAST(user_id % {N_STATIONS} AS VARCHAR) AS StationID,
         value AS Temperature, event_type AS WeatherCode, props,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
  FROM events)""",
    "obs_hourly": f"""obs_hourly AS (
  SELECT StationID, ObservationTime, Temperature, n_events,
         CAST(year(ObservationTime) AS INTEGER) AS year, CAST(month(ObservationTime) AS INTEGER) AS month,
         CAST(day(ObservationTime) AS INTEGER) AS day, CAST(hour(ObservationTime) AS INTEGER) AS hour
  FROM (SELECT CAST(user_id % {N_STATIONS} AS VARCHAR) AS StationID,
               date_trunc('hour', ts) AS ObservationTime,
               avg(value) AS Temperature, count(*) AS n_events
        FROM events GROUP BY 1, 2))""",
    "forecast": f"""forecast AS (
  SELECT StationID, year, month, day, hour, dayname(ObservationTime) AS day_of_week,
         Temperature * {FORECAST_SCALE} + ({FORECAST_SHIFT}) AS pred_Temperature,
         ObservationTime AS datetime, CAST(ObservationTime AS DATE) AS date
  FROM obs_hourly)""",
}





# ---- wide raw observation (46 columns) from events ------------------------------------------------
# Every numeric column i (its position in WEATHER_COLUMNS) is ((k * i + event_id) % 61 - 8) / 2 where
# k is the integer in props; GustTime is null when k % 10 = 0; SnowDepth3Hr is all null;
# WeatherCode is '-' for error events; CloudType cycles '-', 'Sc', 'Cu' with k.
def _wide_numeric_sql(i: int) -> str:
    return f"CAST(((k * {i} + event_id) % 61) - 8 AS DOUBLE) / 2"


WIDE_ROWS_PER_TASK = 200_000


def _spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, or than its rows need, is dealt out; any other stays as it is. Rows are few bytes in
    the file and 46 columns afterwards, so a split that is small by its bytes is a long task; they are counted from the footers."""
    want = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // WIDE_ROWS_PER_TASK))
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def obs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourcast.schema import RAW_SCHEMA, WEATHER_COLUMNS
    # 46 computed columns a row, and wide unpivots downstream: one small file would keep one core busy
    e = _spread(read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint"))
    cols = []
    for i, f in enumerate(RAW_SCHEMA.fields):
        n = f.name
        if n == "ObservationTime":
            c = F.col("ts")
        elif n == "StationID":
            c = (F.col("user_id") % N_STATIONS).cast("string")
        elif n == "Temperature":
            c = F.col("value")
        elif n == "WeatherCode":
            c = F.when(F.col("event_type") == "error", F.lit("-")).otherwise(F.col("event_type"))
        elif n == "CloudType":
            c = F.element_at(F.array(F.lit("-"), F.lit("Sc"), F.lit("Cu")), (F.col("k") % 3 + 1).cast("int"))
        elif n == "SnowDepth3Hr":
            c = F.lit(None).cast("double")
        elif n == "GustTime":
            c = F.when(F.col("k") % 10 != 0, F.expr(_wide_numeric_sql(i)))
        else:
            c = F.expr(_wide_numeric_sql(i))
        cols.append(c.cast(f.dataType).alias(n))
    assert [c for c in WEATHER_COLUMNS] == [f.name for f in RAW_SCHEMA.fields]
    return e.select(F.col("event_id"), *cols).withColumns(tf.time_parts("ObservationTime"))


def _obs_wide_sql() -> str:
    from hourcast.schema import RAW_SCHEMA
    cols = []
    for i, f in enumerate(RAW_SCHEMA.fields):
        n = f.name
        if n == "ObservationTime":
            c = "ts"
        elif n == "StationID":
            c = f"CAST(user_id % {N_STATIONS} AS VARCHAR)"
        elif n == "Temperature":
            c = "value"
        elif n == "WeatherCode":
            c = "CASE WHEN event_type = 'error' THEN '-' ELSE event_type END"
        elif n == "CloudType":
            c = "CASE k % 3 WHEN 0 THEN '-' WHEN 1 THEN 'Sc' ELSE 'Cu' END"
        elif n == "SnowDepth3Hr":
            c = "CAST(NULL AS DOUBLE)"
        elif n == "GustTime":
            c = f"CASE WHEN k % 10 <> 0 THEN {_wide_numeric_sql(i)} END"
        else:
            c = _wide_numeric_sql(i)
        cols.append(f'{c} AS "{n}"')
    return ("obs_wide AS (SELECT event_id, " + ", ".join(cols) +
            ", CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,"
            " CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour"
            " FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))")


SQL_CTES["obs_wide"] = _obs_wide_sql()


def with_ctes(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named adapters (dependencies first)."""
    order = ["obs_events", "obs_hourly", "forecast", "obs_wide"]
    need = set(names)
    if "forecast" in need:
        need.add("obs_hourly")
    return "WITH " + ",\n".join(SQL_CTES[n] for n in order if n in need)
