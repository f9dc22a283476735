"""Daily summaries and advice over a forecast.

A forecast has one row per (series, hour). Every summary groups by (series keys, date) for all
dates at once, so the day query of a serving layer is a filter on a precomputed table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions import advice as adv
from hourcast.functions.numeric import round_exact
from hourcast.functions.timefeat import to_fahrenheit


# Labels of the statistics table, in its order.
LABELS = ("최고기온", "최저기온", "평균기온", "일교차")

def _keys(df: DataFrame, keys) -> list[str]:
    return [k for k in (keys or []) if k in df.columns]


def daily_summary(fc: DataFrame, temp_col: str = "pred_Temperature", keys=("StationID",),
                  date_col: str = "date", digits: int = 2) -> DataFrame:
    """Per day mean, min, max and range (max - min) of the temperature, rounded to ``digits``.

    The band / tip rules are applied by ``daily_advice`` on the unrounded values, as the service does.
    """
    k = _keys(fc, keys) + [date_col]
    agg = fc.groupBy(*k).agg(
        F.avg(temp_col).alias("_avg"), F.min(temp_col).alias("_min"), F.max(temp_col).alias("_max"))
    return agg.withColumn("_diff", F.col("_max") - F.col("_min"))


def daily_advice(fc: DataFrame, temp_col: str = "pred_Temperature", keys=("StationID",),
                 date_col: str = "date", digits: int = 2) -> DataFrame:
    """A6 + F21 + F22 (tip) + F23: daily summary with band, activity tip and layering tip."""
    s = daily_summary(fc, temp_col, keys, date_col)
    k = _keys(fc, keys) + [date_col]
    band = adv.temp_band(F.col("_avg"))
    return s.select(
        *k,
        round_exact("_avg", digits).alias("avg_temp"),
        round_exact("_min", digits).alias("min_temp"),
        round_exact("_max", digits).alias("max_temp"),
        round_exact("_diff", digits).alias("temp_difference"),
        band.alias("band"),
        adv.activity_tip(band).alias("activity_tip"),
        adv.layering_tip(F.col("_diff")).alias("layering_tip"),
    )


def adjusted_summary(fc: DataFrame, sensitivity: str = "보통", unit: str = "C",
                     temp_col: str = "pred_Temperature", keys=("StationID",), date_col: str = "date") -> DataFrame:
    """A7 + F17 + F18: summary of the sensitivity-shifted temperature, shown in C or F.

    The range is always reported in degrees C (as the dashboard does).
    """
    shift = adv.sensitivity_shift(F.lit(sensitivity))
    adj = fc.withColumn("_adj", F.col(temp_col) + shift)
    s = daily_summary(adj, "_adj", keys, date_col)
    show = (lambda c: to_fahrenheit(c)) if unit.upper().startswith("F") else (lambda c: c)
    k = _keys(fc, keys) + [date_col]
    return s.select(
        *k,
        show(F.col("_avg")).alias("avg_display"),
        show(F.col("_min")).alias("min_display"),
        show(F.col("_max")).alias("max_display"),
        F.col("_diff").alias("range_c"),
        adv.layering_tip(F.col("_diff")).alias("layering_tip"),
    )


def extreme_hours(fc: DataFrame, temp_col: str = "pred_Temperature", hour_col: str = "hour",
                  keys=("StationID",), date_col: str = "date") -> DataFrame:
    """Hour of the daily maximum / minimum; on ties the earliest hour wins (idxmax rule)."""
    k = _keys(fc, keys) + [date_col]
    t, h = F.col(temp_col), F.col(hour_col)
    return fc.groupBy(*k).agg(
        F.max_by(h, F.struct(t, -h)).alias("max_hour"),
        F.min_by(h, F.struct(t, h)).alias("min_hour"),
        F.max(t).alias("max_temp"),
        F.min(t).alias("min_temp"),
        F.avg(t).alias("avg_temp"),
    )


def statistics_table(fc: DataFrame, unit: str = "C", temp_col: str = "pred_Temperature",
                     keys=("StationID",), date_col: str = "date") -> DataFrame:
    """A8 + F19: the four-row statistics table (label, value text, hour text) per day."""
    ex = extreme_hours(fc, temp_col, "hour", keys, date_col).withColumn(
        "_range", F.col("max_temp") - F.col("min_temp"))
    f = (lambda c: to_fahrenheit(c)) if unit.upper().startswith("F") else (lambda c: c)
    u = "°F" if unit.upper().startswith("F") else "°C"
    k = _keys(fc, keys) + [date_col]
    txt = lambda c, unit_txt: F.concat(adv.format_1f(c), F.lit(unit_txt))
    hour_txt = lambda c: F.concat(c.cast("string"), F.lit("시"))
    def row(pos, label, value, at):
        return F.struct(F.lit(pos).alias("pos"), F.lit(label).alias("label"),
                        value.alias("value"), at.cast("string").alias("at"))

    rows = F.array(
        row(1, LABELS[0], txt(f(F.col("max_temp")), u), hour_txt(F.col("max_hour"))),
        row(2, LABELS[1], txt(f(F.col("min_temp")), u), hour_txt(F.col("min_hour"))),
        row(3, LABELS[2], txt(f(F.col("avg_temp")), u), F.lit("-")),
        row(4, LABELS[3], txt(F.col("_range"), "°C"), F.lit("-")),
    )
    return ex.select(*k, F.inline(rows))


def style_items(advice: DataFrame, dim: DataFrame, keys=("StationID",), date_col: str = "date") -> DataFrame:
    """J3 + F22: one row per (day, style, category, item) from the band dimension.

    The dimension has a fixed size (about 60 rows), so it is broadcast by construction.
    """
    k = _keys(advice, keys) + [date_col]
    j = advice.select(*k, "band").join(F.broadcast(dim.select("band", "style", "category", "items")), "band")
    return j.select(*k, "band", "style", "category", F.posexplode("items").alias("item_pos", "item"))


def advice_json(advice: DataFrame, dim: DataFrame, keys=("StationID",), date_col: str = "date") -> DataFrame:
    """the nested day record (summary struct + recommendation struct with a styles map) as JSON."""
    k = _keys(advice, keys)
    # entries sorted before building each map: collect_list order after a shuffle is arbitrary,
    # and the JSON text must not change from run to run
    def by_key(field):
        return lambda a, b: F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0)

    styles = (dim.groupBy("band", "style")
              .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "items")), by_key("category")))
                   .alias("cats"))
              .groupBy("band")
              .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("style", "cats")), by_key("style")))
                   .alias("styles")))
    j = advice.join(F.broadcast(styles), "band", "left")
    rec = F.struct(
        F.col(date_col).cast("string").alias("target_date"),
        F.struct("avg_temp", "min_temp", "max_temp", "temp_difference").alias("weather_summary"),
        F.struct("styles", "activity_tip", "layering_tip").alias("recommendations"),
    )
    return j.select(*k, F.col(date_col), F.to_json(rec).alias("advice_json"))


def hourly_mean(df: DataFrame, value_col: str, hour_col: str = "hour", alias: str | None = None) -> DataFrame:
    """A3: mean of ``value_col`` by hour of day (at most 24 rows)."""
    return df.groupBy(hour_col).agg(F.avg(value_col).alias(alias or f"mean_{value_col}"))


def compare_hourly(frames: dict[str, DataFrame], keys=("hour",)) -> DataFrame:
    """Inner join of several hour-of-day tables on ``keys`` (``hour``, or series + hour).

    With ``hour`` alone each side has at most 24 rows and is broadcast; with series keys the sides
    grow with the number of series and the join strategy is left to AQE.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = None
    for _, f in frames.items():
        if out is None:
            out = f
        else:
            out = out.join(F.broadcast(f) if keys == ["hour"] else f, keys)
    return out


def date_rows(fc: DataFrame, day, date_col: str = "date") -> DataFrame:
    """Rows of one date (an empty result is the caller's 'no forecast' case)."""
    d = day if isinstance(day, Column) else F.lit(day).cast("date")
    return fc.filter(F.col(date_col) == d)
