"""Wave 1 queries: text parse, lake write / scans, high-water mark, newest forecast, cleaning."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from hourcast.operators import clean
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import register, sql_norm
from hourcast.schema import IMPOSSIBLE_NEGATIVE_COLUMNS, RAW_SCHEMA, WEATHER_COLUMNS, WEATHER_KOREAN_COLUMNS
from hourcast.session import path_exists
from hourcast.session_paths import scratch, state_tag, tag
from hourcast.sources import files, html, lake, text

WIDE = ad.with_ctes("obs_wide")
RAW_DOUBLES = [f.name for f in RAW_SCHEMA.fields if f.dataType.typeName() == "double"]


def lake_root(spark, sf_dir: str) -> str:
    """Day-partitioned lake of the wide observations for ``sf_dir`` (written on first use per app and state of the input's files)."""
    root = scratch(spark, "lake", state_tag(spark, sf_dir, "events"))
    if not path_exists(spark, root + "/_SUCCESS"):
        lake.write_days(ad.obs_wide(spark, sf_dir).drop("event_id"), root, mode="dynamic")
    return root


# ---- S1 / F1 / F30: text source ----------------------------------------------------------------
def _text_path(spark, sf_dir):
    path = scratch(spark, "text", tag(sf_dir))
    obs = ad.obs_wide(spark, sf_dir)
    lines = text.render_observation_lines(obs)
    # one comment line per day, as the source prints headers
    comments = obs.groupBy(F.to_date("ObservationTime").alias("d")).agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("# START7777 "), F.date_format("d", "yyyyMMdd"), F.lit(" n="), F.col("n").cast("string")).alias("value"))
    lines.unionByName(comments).write.mode("overwrite").text(path)
    return path


@register("parse_text", oracle=sql_norm(
    "SELECT " + ", ".join(
        ["date_trunc('minute', ObservationTime) AS ObservationTime"]
        + [f'coalesce("{c}", -9) AS "{c}"' if c in RAW_DOUBLES else f'"{c}"' for c in WEATHER_COLUMNS[1:]]
        + ["year", "month", "day", "hour"]) + " FROM obs_wide",
    doubles=RAW_DOUBLES, ints=["year", "month", "day", "hour"], ts=["ObservationTime"], with_=WIDE))
def q_parse_text(spark, sf_dir):
    parsed, _rejects = text.read_observation_text(spark, _text_path(spark, sf_dir))
    return parsed


@register("parse_text_korean", oracle=sql_norm(
    "SELECT date_trunc('minute', ObservationTime) AS \"관측시각\", StationID AS \"지점번호\", "
    "Temperature AS \"기온\", WeatherCode AS \"일기코드\", count(*) OVER (PARTITION BY StationID) AS n_station FROM obs_wide",
    doubles=["기온"], ints=["n_station"], ts=["관측시각"], with_=WIDE))
def q_parse_text_korean(spark, sf_dir):
    """S1 with the Korean names (same order, same types), as the source's alternative header."""
    parsed, _ = text.read_observation_text(spark, _text_path(spark, sf_dir), names=WEATHER_KOREAN_COLUMNS)
    n = parsed.groupBy("지점번호").agg(F.count(F.lit(1)).alias("n_station"))
    return parsed.select("관측시각", "지점번호", "기온", "일기코드").join(n, "지점번호")


# ---- S3 / A2: lake write + day counts -------------------------------------------------------------
@register("day_counts", oracle=sql_norm(
    "SELECT year, month, day, count(*) AS n_rows FROM obs_wide GROUP BY 1, 2, 3",
    ints=["year", "month", "day", "n_rows"], with_=WIDE))
def q_day_counts(spark, sf_dir):
    return lake.day_counts(spark.read.parquet(lake_root(spark, sf_dir)))


# ---- S4: lookback scan with partition pruning -----------------------------------------------------
LOOKBACK_AS_OF, LOOKBACK_DAYS = "2024-01-20", 7


@register("lookback_scan", oracle=sql_norm(
    f"""SELECT StationID, CAST(ObservationTime AS DATE) AS obs_date, count(*) AS n_rows,
       avg(Temperature) AS mean_temp, min(ObservationTime) AS first_time, max(ObservationTime) AS last_time
FROM obs_wide
WHERE CAST(ObservationTime AS DATE) BETWEEN DATE '{LOOKBACK_AS_OF}' - INTERVAL {LOOKBACK_DAYS} DAY AND DATE '{LOOKBACK_AS_OF}'
GROUP BY 1, 2""",
    doubles=["mean_temp"], ints=["n_rows"], ts=["first_time", "last_time"], dates=["obs_date"], with_=WIDE))
def q_lookback_scan(spark, sf_dir):
    df = lake.scan_lookback(spark, lake_root(spark, sf_dir), LOOKBACK_AS_OF, LOOKBACK_DAYS)
    return df.groupBy("StationID", F.to_date("ObservationTime").alias("obs_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("Temperature").alias("mean_temp"),
        F.min("ObservationTime").alias("first_time"), F.max("ObservationTime").alias("last_time"))


@register("month_scan", oracle=sql_norm(
    """SELECT year, month, count(*) AS n_rows, count(DISTINCT StationID) AS n_stations
FROM obs_wide WHERE year * 100 + month BETWEEN 202101 AND 202402 GROUP BY 1, 2""",
    ints=["year", "month", "n_rows", "n_stations"], with_=WIDE))
def q_month_scan(spark, sf_dir):
    """Months from January of (as_of - 3 years) to as_of's month."""
    df = lake.scan_months(spark, lake_root(spark, sf_dir), "2024-02-15")
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count_distinct("StationID").alias("n_stations"))


@register("recursive_scan", oracle=sql_norm(
    """SELECT StationID, count(*) AS n_rows, sum(Temperature) AS sum_temp
FROM obs_wide WHERE year = 2024 AND month = 1 GROUP BY 1""",
    doubles=["sum_temp"], ints=["n_rows"], with_=WIDE))
def q_recursive_scan(spark, sf_dir):
    """S6 (train mode): year / month filter, unreadable files skipped."""
    df = lake.scan_recursive(spark, lake_root(spark, sf_dir), year=2024, month=1)
    return df.groupBy("StationID").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("Temperature").alias("sum_temp"))


# ---- S7 / S8: high-water mark ---------------------------------------------------------------------
@register("high_water_mark", oracle=sql_norm(
    "SELECT max(ObservationTime) AS high_water_mark, true AS has_data FROM obs_wide",
    ts=["high_water_mark"], with_=WIDE))
def q_high_water_mark(spark, sf_dir):
    root = lake_root(spark, sf_dir)
    present = lake.has_data(spark, root)
    return lake.high_water_mark(spark, root).withColumn("has_data", F.lit(present))


# ---- S12 / S13: newest forecast run -----------------------------------------------------------------
@register("latest_forecast", oracle=sql_norm(
    """SELECT StationID, year, month, day, hour, day_of_week, pred_Temperature, datetime, date FROM forecast""",
    doubles=["pred_Temperature"], ints=["year", "month", "day", "hour"], ts=["datetime"], dates=["date"],
    with_=ad.with_ctes("forecast")))
def q_latest_forecast(spark, sf_dir):
    root = scratch(spark, "forecast", tag(sf_dir))
    fc = ad.forecast(spark, sf_dir)
    # an older run with a different scale, then the current run: only the newest may be read back
    files.write_forecast(fc.withColumn("pred_Temperature", F.col("pred_Temperature") + 100.0), root, "20240101_0000")
    files.write_forecast(fc, root, "20240102_0000")
    return files.latest_forecast(spark, root).drop("run_ts")


# ---- P1 / A5 helper: '-' replacement --------------------------------------------------------------
@register("replace_dash", oracle=sql_norm(
    """SELECT event_id, CASE WHEN WeatherCode = '-' THEN 'Other' ELSE WeatherCode END AS WeatherCode,
       CASE WHEN CloudType = '-' THEN 'Other' ELSE CloudType END AS CloudType, StationID FROM obs_wide""",
    ints=["event_id"], with_=WIDE))
def q_replace_dash(spark, sf_dir):
    df = ad.obs_wide(spark, sf_dir).select("event_id", "WeatherCode", "CloudType", "StationID")
    return clean.replace_missing_token(df, columns=["WeatherCode", "CloudType", "StationID"])


# ---- P2: clamp impossible negatives ----------------------------------------------------------------
@register("clamp_negative", oracle=sql_norm(
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
    doubles=["c_acctbal"], ints=["c_custkey"]))
def q_clamp_negative(spark, sf_dir):
    c = ad.read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return clean.clamp_negative(c, ["c_acctbal"])


@register("clamp_observations", oracle=sql_norm(
    "SELECT event_id, " + ", ".join(
        f'CASE WHEN "{c}" < 0 THEN 0 ELSE "{c}" END AS "{c}"' for c in IMPOSSIBLE_NEGATIVE_COLUMNS)
    + " FROM obs_wide",
    doubles=list(IMPOSSIBLE_NEGATIVE_COLUMNS), ints=["event_id"], with_=WIDE))
def q_clamp_observations(spark, sf_dir):
    df = ad.obs_wide(spark, sf_dir).select("event_id", *IMPOSSIBLE_NEGATIVE_COLUMNS)
    return clean.clamp_negative(df)


# ---- U1: union by name ------------------------------------------------------------------------------
@register("union_frames", oracle=sql_norm(
    """SELECT event_id, StationID, Temperature, WeatherCode, NULL::VARCHAR AS CloudType FROM obs_wide WHERE year * 100 + month <= 202401 AND day <= 15
UNION ALL
SELECT event_id, StationID, Temperature, NULL::VARCHAR AS WeatherCode, CloudType FROM obs_wide WHERE day > 15""",
    doubles=["Temperature"], ints=["event_id"], with_=WIDE))
def q_union_frames(spark, sf_dir):
    o = ad.obs_wide(spark, sf_dir)
    a = o.filter(F.col("day") <= 15).select("event_id", "StationID", "Temperature", "WeatherCode")
    b = o.filter(F.col("day") > 15).select("event_id", "CloudType", "Temperature", "StationID")
    return clean.union_all([a, b])


# ---- S14: CSV round trip ------------------------------------------------------------------------------
@register("csv_roundtrip", oracle=sql_norm(
    "SELECT StationID, ObservationTime, Temperature, WeatherCode FROM obs_wide",
    doubles=["Temperature"], ts=["ObservationTime"], with_=WIDE))
def q_csv_roundtrip(spark, sf_dir):
    from pyspark.sql import types as T
    path = scratch(spark, "csv", tag(sf_dir))
    o = ad.obs_wide(spark, sf_dir).select("StationID", "ObservationTime", "Temperature", "WeatherCode")
    files.write_csv(o, path)
    schema = T.StructType([T.StructField("StationID", T.StringType()), T.StructField("ObservationTime", T.TimestampNTZType()),
                           T.StructField("Temperature", T.DoubleType()), T.StructField("WeatherCode", T.StringType())])
    return files.read_csv(spark, path, schema)


# ---- S17: non-ASCII column names through parquet ------------------------------------------------------
@register("korean_roundtrip", oracle=sql_norm(
    "SELECT CAST(CAST(ObservationTime AS DATE) AS VARCHAR) AS \"날짜\", Temperature AS \"기온\", "
    "CAST(trunc(RelativeHumidity) AS BIGINT) AS \"습도\" FROM obs_wide",
    doubles=["기온"], ints=["습도"], with_=WIDE))
def q_korean_roundtrip(spark, sf_dir):
    path = scratch(spark, "korean", tag(sf_dir))
    o = ad.obs_wide(spark, sf_dir).select(
        F.to_date("ObservationTime").cast("string").alias("날짜"), F.col("Temperature").alias("기온"),
        F.col("RelativeHumidity").cast("bigint").alias("습도"))
    return files.round_trip(o, path)


# ---- F27: regex extract (dot-all, lazy) on the raw pages ------------------------------------------------
@register("html_title", oracle=sql_norm(
    r"""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
       regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages""", ints=["page_id"]))
def q_html_title(spark, sf_dir):
    p = ad.read(spark, sf_dir, "pages")
    return p.select("page_id", html.extract(F.col("html"), r"(?s)<title>(.*?)</title>").alias("title"),
                    html.extract(F.col("url"), r"^https?://([^/]+)").alias("host"))


# ---- S15 / F28 / F29: JSON array embedded in HTML ---------------------------------------------------------
# Weekday letters of the pages, Monday first.
WEEKDAYS = ("월", "화", "수", "목", "금", "토", "일")


def weekly_pages(spark, sf_dir):
    """HTML pages that Spark renders from the daily forecast: one page per (station, ISO week)."""
    fc = ad.with_forecast_time(ad.forecast(spark, sf_dir))
    daily = fc.groupBy("StationID", "date").agg(F.max("pred_Temperature").alias("mx"), F.min("pred_Temperature").alias("mn"))
    ko = F.element_at(F.array(*[F.lit(x) for x in WEEKDAYS]), (F.weekday("date") + 1).cast("int"))
    item = F.struct(F.date_format("date", "yyyyMMdd").alias("aplYmd"),
                    F.format_string("%.0f", F.col("mx")).alias("maxTmpr"),
                    F.format_string("%.0f", F.col("mn")).alias("minTmpr"), ko.alias("dayString"))
    pages = (daily.groupBy("StationID", F.date_trunc("week", "date").alias("week"))
             .agg(F.to_json(F.sort_array(F.collect_list(item))).alias("arr")))
    return pages.select("StationID", F.concat(F.lit('<html><script>window.__s = {"a": 1, "domesticWeeklyFcastList" : '),
                                              F.col("arr"), F.lit(', "other": [{"x": 2}]};</script></html>')).alias("html"))


@register("embedded_json", oracle=sql_norm(
    """SELECT StationID, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day,
       CAST(printf('%.0f', max(pred_Temperature)) AS DOUBLE) AS max_temp, CAST(printf('%.0f', min(pred_Temperature)) AS DOUBLE) AS min_temp,
       dayname(date) AS day_of_week
FROM forecast GROUP BY StationID, date""",
    doubles=["max_temp", "min_temp"], with_=ad.with_ctes("forecast")))
def q_embedded_json(spark, sf_dir):
    return html.weekly_forecast(weekly_pages(spark, sf_dir), keep=("StationID",))


# ---- S10 / A1: snapshot named by min / max time ----------------------------------------------------------
@register("snapshot", oracle=sql_norm(
    """SELECT min(ObservationTime) AS min_time, max(ObservationTime) AS max_time,
       strftime(min(ObservationTime), '%Y.%m.%d_%H%M') || '_' || strftime(max(ObservationTime), '%Y.%m.%d_%H%M') AS snapshot,
       count(*) AS n_rows
FROM obs_wide WHERE CAST(ObservationTime AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'""",
    ts=["min_time", "max_time"], ints=["n_rows"], with_=WIDE))
def q_snapshot(spark, sf_dir):
    """Scan the 30-day lookback, write the snapshot folder named by its time span, read it back."""
    df = lake.scan_lookback(spark, lake_root(spark, sf_dir), "2024-01-30", 29)
    path = files.write_snapshot(df, scratch(spark, "snapshot", tag(sf_dir)))
    snap = spark.read.parquet(path)
    name = os.path.basename(path)
    return snap.agg(F.min("ObservationTime").alias("min_time"), F.max("ObservationTime").alias("max_time"),
                    F.count(F.lit(1)).alias("n_rows")).withColumn("snapshot", F.lit(name)).select(
        "min_time", "max_time", "snapshot", "n_rows")


# ---- S6 inference mode: the lexicographically last file only --------------------------------------------
@register("recursive_scan_latest", oracle=sql_norm(
    """SELECT StationID, count(*) AS n_rows FROM obs_wide
WHERE CAST(ObservationTime AS DATE) = (SELECT max(CAST(ObservationTime AS DATE)) FROM obs_wide) GROUP BY 1""",
    ints=["n_rows"], with_=WIDE))
def q_recursive_scan_latest(spark, sf_dir):
    """S6 / O5 by path: all files of the newest day of the common lake."""
    df = lake.scan_recursive(spark, lake_root(spark, sf_dir), latest_file_only=True)
    return df.groupBy("StationID").agg(F.count(F.lit(1)).alias("n_rows"))


# ---- O5 by modification time ------------------------------------------------------------------------------
@register("latest_forecast_mtime", oracle=sql_norm(
    "SELECT StationID, count(*) AS n_rows, sum(pred_Temperature) AS sum_pred FROM forecast GROUP BY 1",
    doubles=["sum_pred"], ints=["n_rows"], with_=ad.with_ctes("forecast")))
def q_latest_forecast_mtime(spark, sf_dir):
    """S13 with ``by='mtime'``: two runs written one after the other, the newer file wins."""
    import time as _t
    root = scratch(spark, "forecast_mtime", tag(sf_dir))
    fc = ad.forecast(spark, sf_dir).repartition(4)  # a run of several files
    files.write_forecast(fc.withColumn("pred_Temperature", F.col("pred_Temperature") - 50.0), root, "b_old")
    _t.sleep(1.1)  # file modification times have second resolution on some stores
    files.write_forecast(fc, root, "a_new")
    d = files.latest_forecast(spark, root, by="mtime")
    return d.groupBy("StationID").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("pred_Temperature").alias("sum_pred"))


# ---- P15: first rows ----------------------------------------------------------------------------------------
@register("first_rows", oracle=sql_norm(
    "SELECT event_id, ObservationTime, StationID, Temperature FROM obs_wide ORDER BY ObservationTime, event_id LIMIT 5",
    doubles=["Temperature"], ints=["event_id"], ts=["ObservationTime"], with_=WIDE))
def q_first_rows(spark, sf_dir):
    """A head() of the time-ordered observations (the limit is the feature: a top-k)."""
    return ad.obs_wide(spark, sf_dir).select("event_id", "ObservationTime", "StationID", "Temperature").orderBy(
        "ObservationTime", "event_id").limit(5)


# ---- A4: distinct values; P8 casts; F26 zero-padded path parts ------------------------------------------------
@register("distinct_values", oracle=sql_norm(
    "SELECT DISTINCT o_orderpriority FROM orders"))
def q_distinct_values(spark, sf_dir):
    from hourcast.operators import profile
    return profile.distinct_values(ad.read(spark, sf_dir, "orders"), "o_orderpriority")


@register("casts_and_paths", oracle=sql_norm(
    """SELECT event_id, CAST(user_id % 4 AS VARCHAR) AS StationID, CAST(year(ts) AS INTEGER) AS year,
       CAST(CAST(value AS FLOAT) AS DOUBLE) AS value_f32, TRY_CAST(props AS DOUBLE) AS props_num,
       'year=' || CAST(year(ts) AS VARCHAR) || '/month=' || lpad(CAST(month(ts) AS VARCHAR), 2, '0')
         || '/day=' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS path
FROM events""", doubles=["value_f32", "props_num"], ints=["event_id", "year"]))
def q_casts_and_paths(spark, sf_dir):
    """P8 (string / int / float32 / text->number casts) and F26 (zero-padded partition path)."""
    from hourcast.functions.text import zero_pad
    e = ad.read(spark, sf_dir, "events")
    c = clean.cast_columns(e.select("event_id", "user_id", "ts", "value", "props").withColumn("user_id", F.col("user_id") % 4),
                           {"user_id": "string", "value": "float", "props": "double"})
    return c.select("event_id", F.col("user_id").alias("StationID"), F.year("ts").alias("year"),
                    F.col("value").cast("double").alias("value_f32"), F.col("props").alias("props_num"),
                    F.concat(F.lit("year="), F.year("ts").cast("string"), F.lit("/month="), zero_pad(F.month("ts"), 2),
                             F.lit("/day="), zero_pad(F.dayofmonth("ts"), 2)).alias("path"))
