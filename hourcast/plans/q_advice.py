"""Advice queries (waves 0 and 6): daily advice, summaries, extremes, styles, sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourcast.functions import advice as adv
from hourcast.functions import text as tx
from hourcast.functions.numeric import round_scaled
from hourcast.operators import advise
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import printed, register, sql_norm

FC = ad.with_ctes("forecast")


def _fc(spark, sf_dir):
    return ad.with_forecast_time(ad.forecast(spark, sf_dir))


@register("daily_advice", oracle=sql_norm("""
SELECT StationID, date,
       """ + printed("avg(pred_Temperature)", 2) + """ AS avg_temp,
       """ + printed("min(pred_Temperature)", 2) + """ AS min_temp,
       """ + printed("max(pred_Temperature)", 2) + """ AS max_temp,
       """ + printed("max(pred_Temperature) - min(pred_Temperature)", 2) + """ AS temp_difference,
       """ + adv.band_case_sql("avg(pred_Temperature)") + """ AS band,
       """ + adv.activity_case_sql(adv.band_case_sql("avg(pred_Temperature)")) + """ AS activity_tip,
       """ + adv.layering_case_sql("(max(pred_Temperature) - min(pred_Temperature))") + """ AS layering_tip
FROM forecast GROUP BY StationID, date""",
    doubles=["avg_temp", "min_temp", "max_temp", "temp_difference"], dates=["date"], with_=FC))
def q_daily_advice(spark, sf_dir):
    return advise.daily_advice(_fc(spark, sf_dir))


@register("hourly_mean", oracle=sql_norm(
    "SELECT hour, avg(Temperature) AS mean_Temperature FROM obs_hourly GROUP BY 1",
    doubles=["mean_Temperature"], ints=["hour"], with_=ad.with_ctes("obs_hourly")))
def q_hourly_mean(spark, sf_dir):
    return advise.hourly_mean(ad.obs_hourly(spark, sf_dir), "Temperature")


@register("predicted_vs_actual", oracle=sql_norm("""
SELECT p.hour, p.Predicted, a.Actual FROM
 (SELECT hour, avg(pred_Temperature) AS Predicted FROM forecast GROUP BY 1) p
 JOIN (SELECT hour, avg(Temperature) AS Actual FROM obs_hourly GROUP BY 1) a ON p.hour = a.hour""",
    doubles=["Predicted", "Actual"], ints=["hour"], with_=FC))
def q_predicted_vs_actual(spark, sf_dir):
    """Hourly means of forecast and actuals joined on hour (24-row sides, broadcast)."""
    pred = advise.hourly_mean(ad.forecast(spark, sf_dir), "pred_Temperature", alias="Predicted")
    act = advise.hourly_mean(ad.obs_hourly(spark, sf_dir), "Temperature", alias="Actual")
    return advise.compare_hourly({"p": pred, "a": act})


@register("adjusted_summary", oracle=sql_norm("""
SELECT StationID, date, avg(t) * 9.0 / 5.0 + 32.0 AS avg_display, min(t) * 9.0 / 5.0 + 32.0 AS min_display,
       max(t) * 9.0 / 5.0 + 32.0 AS max_display, max(t) - min(t) AS range_c,
       """ + adv.layering_case_sql("(max(t) - min(t))") + """ AS layering_tip
FROM (SELECT StationID, date, pred_Temperature + 1.5 AS t FROM forecast) GROUP BY 1, 2""",
    doubles=["avg_display", "min_display", "max_display", "range_c"], dates=["date"], with_=FC))
def q_adjusted_summary(spark, sf_dir):
    """A7 + F17 + F18: 'feels cold' (+1.5) shown in Fahrenheit; the range stays in Celsius."""
    return advise.adjusted_summary(_fc(spark, sf_dir), sensitivity="추위 탐", unit="F")


@register("extreme_hours", oracle=sql_norm("""
SELECT StationID, date, first(hour ORDER BY pred_Temperature DESC, hour) AS max_hour,
       first(hour ORDER BY pred_Temperature ASC, hour) AS min_hour,
       max(pred_Temperature) AS max_temp, min(pred_Temperature) AS min_temp, avg(pred_Temperature) AS avg_temp
FROM forecast GROUP BY 1, 2""",
    doubles=["max_temp", "min_temp", "avg_temp"], ints=["max_hour", "min_hour"], dates=["date"], with_=FC))
def q_extreme_hours(spark, sf_dir):
    return advise.extreme_hours(_fc(spark, sf_dir))


@register("statistics_table", oracle=sql_norm("""
WITH ex AS (SELECT StationID, date, first(hour ORDER BY pred_Temperature DESC, hour) AS max_hour,
       first(hour ORDER BY pred_Temperature ASC, hour) AS min_hour,
       max(pred_Temperature) AS mx, min(pred_Temperature) AS mn, avg(pred_Temperature) AS av
       FROM forecast GROUP BY 1, 2)
SELECT StationID, date, 1 AS pos, '최고기온' AS label, printf('%.1f', mx) || '°C' AS value, CAST(max_hour AS VARCHAR) || '시' AS "at" FROM ex
UNION ALL SELECT StationID, date, 2, '최저기온', printf('%.1f', mn) || '°C', CAST(min_hour AS VARCHAR) || '시' FROM ex
UNION ALL SELECT StationID, date, 3, '평균기온', printf('%.1f', av) || '°C', '-' FROM ex
UNION ALL SELECT StationID, date, 4, '일교차', printf('%.1f', mx - mn) || '°C', '-' FROM ex""",
    ints=["pos"], dates=["date"], with_=FC))
def q_statistics_table(spark, sf_dir):
    """A8 + F19: four-row statistics table per day (Celsius)."""
    return advise.statistics_table(_fc(spark, sf_dir), unit="C")


def dim_values_sql() -> str:
    rows = []
    for band, _ in adv.BANDS:
        for style, cats in adv.STYLE_RECOMMENDATIONS[band]["items"].items():
            for cat, items in cats.items():
                for i, it in enumerate(items):
                    rows.append(f"('{band}', '{style}', '{cat}', {i}, '{it}')")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") d(band, style, category, item_pos, item)"


@register("style_items", oracle=sql_norm(f"""
SELECT a.StationID, a.date, a.band, d.style, d.category, d.item_pos, d.item
FROM (SELECT StationID, date, {adv.band_case_sql('avg(pred_Temperature)')} AS band FROM forecast GROUP BY 1, 2) a
JOIN ({dim_values_sql()}) d ON a.band = d.band""", ints=["item_pos"], dates=["date"], with_=FC))
def q_style_items(spark, sf_dir):
    """J3 + F22: each day's band joined to the (fixed-size, broadcast) style dimension."""
    a = advise.daily_advice(_fc(spark, sf_dir))
    return advise.style_items(a, adv.band_dimension(spark))


@register("advice_json", oracle=sql_norm(f"""
WITH a AS (SELECT StationID, date, avg(pred_Temperature) AS av, min(pred_Temperature) AS mn, max(pred_Temperature) AS mx,
                  {adv.band_case_sql('avg(pred_Temperature)')} AS band FROM forecast GROUP BY 1, 2)
SELECT a.StationID, a.date, strftime(a.date, '%Y-%m-%d') AS target_date, {printed('a.av', 2)} AS avg_temp, {printed('a.mn', 2)} AS min_temp,
       {printed('a.mx', 2)} AS max_temp, {printed('a.mx - a.mn', 2)} AS temp_difference,
       {adv.activity_case_sql('a.band')} AS activity_tip, {adv.layering_case_sql('(a.mx - a.mn)')} AS layering_tip,
       d.style, d.category, d.item_pos, d.item
FROM a JOIN ({dim_values_sql()}) d ON a.band = d.band""".replace("WITH a AS", "SELECT * FROM (WITH a AS", 1) + ")",
    doubles=["avg_temp", "min_temp", "max_temp", "temp_difference"], ints=["item_pos"], dates=["date"], with_=FC))
def q_advice_json(spark, sf_dir):
    """the nested day record (summary + styles map + tips) as JSON per station and day, read back field by field."""
    made = advise.advice_json(advise.daily_advice(_fc(spark, sf_dir)), adv.band_dimension(spark))
    schema = ("target_date string, weather_summary struct<avg_temp double, min_temp double, max_temp double, temp_difference double>, "
              "recommendations struct<styles map<string, map<string, array<string>>>, activity_tip string, layering_tip string>")
    r = made.select("StationID", "date", F.from_json("advice_json", schema).alias("r")).select("StationID", "date", "r.target_date", "r.weather_summary.*", "r.recommendations.*")
    r = r.select(*[c for c in r.columns if c != "styles"], F.explode("styles").alias("style", "categories"))
    r = r.select(*[c for c in r.columns if c != "categories"], F.explode("categories").alias("category", "items"))
    return r.select(*[c for c in r.columns if c != "items"], F.posexplode("items").alias("item_pos", "item"))


def _sentence_sql(t: str, s: str) -> str:
    adj = f"({t} + CASE {s} WHEN 'cold' THEN -2.0 WHEN 'hot' THEN 2.0 ELSE 0.0 END)"
    whens = " ".join(f"WHEN {adj} >= {lim} THEN '{txt}'" for lim, txt in adv.CLOTH_SENSE_RULES if lim is not None)
    last = adv.CLOTH_SENSE_RULES[-1][1]
    head, tail = adv.CLOTH_SENSE_PREFIX.split("{t}")
    return f"'{head}' || printf('%.1f', {t}) || '{tail}' || CASE {whens} ELSE '{last}' END"


@register("clothing_sentence", oracle=sql_norm(f"""
SELECT StationID, datetime, s AS sensitivity, {_sentence_sql('pred_Temperature', 's')} AS sentence
FROM forecast, (VALUES ('cold'), ('normal'), ('hot')) v(s)""", ts=["datetime"], with_=FC))
def q_clothing_sentence(spark, sf_dir):
    """The clothing sentence of every forecast hour for three sensitivities."""
    fc = _fc(spark, sf_dir).withColumn("shown", adv.format_1f("pred_Temperature"))
    fc = fc.withColumn("sensitivity", F.explode(F.array(F.lit("cold"), F.lit("normal"), F.lit("hot"))))
    return fc.select("StationID", "datetime", "sensitivity",
                     adv.clothing_sentence(F.col("pred_Temperature"), F.col("sensitivity"), F.col("shown")).alias("sentence"))


@register("suffix_increment", oracle=sql_norm("""
SELECT event_id, name, CASE WHEN TRY_CAST(split_part(name, '-', -1) AS BIGINT) IS NOT NULL THEN
  replace(name, split_part(name, '-', -1), printf('%03d', TRY_CAST(split_part(name, '-', -1) AS BIGINT) + 1)) END AS next_name
FROM (SELECT event_id, event_type || '-' || CAST(user_id AS VARCHAR) || '-' ||
             CASE WHEN event_type = 'error' THEN 'x' ELSE lpad(CAST(user_id AS VARCHAR), 3, '0') END AS name FROM events)""",
    ints=["event_id"]))
def q_suffix_increment(spark, sf_dir):
    """F25 on run names derived from events (the numeric part repeats, so every copy is replaced)."""
    e = ad.read(spark, sf_dir, "events")
    name = F.concat_ws("-", F.col("event_type"), F.col("user_id").cast("string"),
                       F.when(F.col("event_type") == "error", F.lit("x"))
                       .otherwise(F.lpad(F.col("user_id").cast("string"), 3, "0")))
    return e.select("event_id", name.alias("name")).withColumn("next_name", tx.increment_suffix(F.col("name"), 3))


@register("forecast_dates", oracle=sql_norm(
    "SELECT DISTINCT StationID, date FROM forecast", dates=["date"], with_=FC))
def q_forecast_dates(spark, sf_dir):
    """Sorted distinct forecast dates per series."""
    return _fc(spark, sf_dir).select("StationID", "date").distinct().orderBy("StationID", "date")


@register("day_detail", oracle=sql_norm("""
SELECT StationID, hour, CAST(hour AS VARCHAR) || '시' AS hour_text, """ + "round_even(round(pred_Temperature * 9.0 / 5.0 + 32.0, 10) * 10.0, 0) / 10.0" + """ AS display_temp
FROM forecast WHERE date = DATE '2024-01-15'""", doubles=["display_temp"], ints=["hour"], with_=FC))
def q_day_detail(spark, sf_dir):
    """P6 + O4 + F17 + F20: one day's rows by hour, shown in Fahrenheit, rounded to 1 digit."""
    from hourcast.functions.timefeat import to_fahrenheit
    d = advise.date_rows(_fc(spark, sf_dir), "2024-01-15")
    return d.select("StationID", "hour", F.concat(F.col("hour").cast("string"), F.lit("시")).alias("hour_text"),
                    round_scaled(to_fahrenheit("pred_Temperature"), 1).alias("display_temp")).orderBy("StationID", "hour")
