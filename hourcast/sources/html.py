"""A JSON array embedded in an HTML page -> typed weekly forecast rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.functions.advice import WEEKDAY_KO_TO_EN

# Fixed value: the pattern of the page key whose array holds the weekly forecast.
WEEKLY_PATTERN = r'(?s)"domesticWeeklyFcastList"\s*:\s*(\[\{.*?\}\])'

WEEKLY_ITEM = T.ArrayType(T.StructType([
    T.StructField("aplYmd", T.StringType()),
    T.StructField("maxTmpr", T.StringType()),
    T.StructField("minTmpr", T.StringType()),
    T.StructField("dayString", T.StringType()),
]))


def extract(html: Column, pattern: str, group: int = 1) -> Column:
    """regex extract with dot-matches-newline and lazy quantifiers in the pattern."""
    return F.regexp_extract(html, pattern, group)


def weekday_to_english(c: Column) -> Column:
    """Korean one-letter weekday -> English name (unknown -> null)."""
    pairs = []
    for k, v in WEEKDAY_KO_TO_EN.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), c)


def weekly_forecast(pages: DataFrame, html_col: str = "html", keep=()) -> DataFrame:
    """Extract the array, parse it, keep 4 fields, split the date, rename, map weekdays."""
    arr = F.from_json(F.nullif(extract(F.col(html_col), WEEKLY_PATTERN), F.lit("")), WEEKLY_ITEM)
    rows = pages.select(*keep, F.inline(arr))
    d = F.to_date(F.col("aplYmd"), "yyyyMMdd")
    return rows.select(
        *keep,
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.col("maxTmpr").try_cast("double").alias("max_temp"),
        F.col("minTmpr").try_cast("double").alias("min_temp"),
        weekday_to_english(F.col("dayString")).alias("day_of_week"),
    )
