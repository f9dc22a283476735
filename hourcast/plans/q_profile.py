"""Wave 3 queries: describe, null / dash counts, IQR outliers, negatives, histogram, distinct counts,
column profile, table diff, shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourcast.operators import clean, profile
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import printed, register, sql_norm
from hourcast.schema import RAW_SCHEMA, numeric_columns

WIDE = ad.with_ctes("obs_wide")
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
OBS_NUM = numeric_columns(RAW_SCHEMA)


def _q(cols):
    return ", ".join(f'"{c}"' for c in cols)


def _long_sql(src: str, cols, nulls: bool = True) -> str:
    casted = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols)
    inc = "INCLUDE NULLS " if nulls else ""
    return f'long AS (FROM (SELECT {casted} FROM {src}) UNPIVOT {inc}(value FOR "column" IN ({_q(cols)})))'


def _describe_sql(src, cols, with_=""):
    pre = (with_ + ",\n" if with_ else "WITH ") + _long_sql(src, cols)
    return sql_norm(
        """SELECT "column", count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
       quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75,
       max(value) AS max FROM long GROUP BY 1""",
        doubles=["mean", "std", "min", "p25", "p50", "p75", "max"], ints=["count"], with_=pre)


@register("describe", oracle=_describe_sql("lineitem", LI_NUM))
def q_describe(spark, sf_dir):
    return profile.describe(ad.read(spark, sf_dir, "lineitem"), LI_NUM)


@register("describe_observations", oracle=_describe_sql("obs_wide", OBS_NUM, WIDE))
def q_describe_observations(spark, sf_dir):
    """A9 over the 43 numeric observation columns (one all-null, one partly null)."""
    return profile.describe(ad.obs_wide(spark, sf_dir), OBS_NUM)


def _iqr_sql(src, cols, with_=""):
    pre = (with_ + ",\n" if with_ else "WITH ") + _long_sql(src, cols)
    return sql_norm(
        """SELECT l."column" AS "Column",
       count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS "Outlier Count",
       """ + printed("count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) / count(*) * 100", 3) + """ AS "Outlier Ratio (%)"
FROM long l LEFT JOIN (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
                       FROM long GROUP BY 1) b ON l."column" = b."column"
GROUP BY 1""", doubles=["Outlier Ratio (%)"], ints=["Outlier Count"], with_=pre)


@register("iqr_outliers", oracle=_iqr_sql("lineitem", LI_NUM))
def q_iqr_outliers(spark, sf_dir):
    return profile.outlier_iqr(ad.read(spark, sf_dir, "lineitem"), LI_NUM)


@register("iqr_outliers_observations", oracle=sql_norm(
    """SELECT * FROM iq WHERE "Outlier Ratio (%)" > 0
  AND "Column" NOT IN ('PastWeatherCode', 'ObservationType', 'PrecipitationData', 'CurrentWeatherCode', 'GustTime')""",
    with_=_iqr_sql("obs_wide", OBS_NUM, WIDE).replace("\nSELECT * REPLACE", ",\niq AS (SELECT * REPLACE", 1) + ")"))
def q_iqr_outliers_observations(spark, sf_dir):
    """A10 + P10 + P11: outliers of the observation columns, ratio > 0, domain columns excluded."""
    from hourcast.schema import OUTLIER_DOMAIN_EXCLUDE
    o = profile.outlier_iqr(ad.obs_wide(spark, sf_dir), OBS_NUM)
    o = o.filter(F.col("Outlier Ratio (%)") > 0)
    return clean.exclude_values(o, "Column", OUTLIER_DOMAIN_EXCLUDE)


@register("negative_columns", oracle=sql_norm(
    """SELECT "column", coalesce(bool_or(value < 0), false) AS has_negative FROM long GROUP BY 1""",
    with_=WIDE + ",\n" + _long_sql("obs_wide", OBS_NUM)))
def q_negative_columns(spark, sf_dir):
    return profile.negative_columns(ad.obs_wide(spark, sf_dir), OBS_NUM)


def _null_dash_sql():
    parts = []
    for f in RAW_SCHEMA.fields:
        is_text = f.dataType.typeName() == "string"
        dash = f"count_if(\"{f.name}\" = '-')" if is_text else "0"
        parts.append(f"SELECT '{f.name}' AS \"column\", count_if(\"{f.name}\" IS NULL) AS null_count, {dash} AS token_count FROM obs_wide")
    return sql_norm("\nUNION ALL ".join(parts), ints=["null_count", "token_count"], with_=WIDE)


@register("null_dash_counts", oracle=_null_dash_sql())
def q_null_dash_counts(spark, sf_dir):
    return profile.null_and_token_counts(ad.obs_wide(spark, sf_dir).drop("event_id", "year", "month", "day", "hour"))


def _hist_sql(src, cols, bins=30, with_="", label=None):
    pre = (with_ + ",\n" if with_ else "WITH ") + _long_sql(src, cols, nulls=False)
    lab = f", '{label}' AS label" if label else ""
    return sql_norm(f"""SELECT "column", CAST(b AS BIGINT) + 1 AS bin, lo + (hi - lo) * b / {bins} AS bin_low,
       lo + (hi - lo) * (b + 1) / {bins} AS bin_high, count(*) AS count{lab}
FROM (SELECT l."column", value, lo, hi,
             CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((value - lo) / (hi - lo) * {bins}), {bins - 1}) END AS b
      FROM long l JOIN (SELECT "column", min(value) AS lo, max(value) AS hi FROM long GROUP BY 1) r
        ON l."column" = r."column")
GROUP BY "column", b, lo, hi""", doubles=["bin_low", "bin_high"], ints=["bin", "count"], with_=pre)


@register("histogram", oracle=_hist_sql("lineitem", LI_NUM))
def q_histogram(spark, sf_dir):
    return profile.histogram(ad.read(spark, sf_dir, "lineitem"), LI_NUM, bins=30)


@register("histogram_two_groups", oracle=(
    _hist_sql("(SELECT * FROM obs_wide WHERE WeatherCode = 'click')", ["Temperature"], with_=WIDE, label="click")
    + "\nUNION ALL\n" +
    _hist_sql("(SELECT * FROM obs_wide WHERE WeatherCode = 'view')", ["Temperature"], with_=WIDE, label="view")
).replace("\nUNION ALL\n" + WIDE + ",", "\nUNION ALL\n(WITH", 1) + ")")
def q_histogram_two_groups(spark, sf_dir):
    """A16 two-frame form: the same column in two groups, each binned over its own range."""
    o = ad.obs_wide(spark, sf_dir)
    a = profile.histogram(o.filter(F.col("WeatherCode") == "click"), ["Temperature"], label="click")
    b = profile.histogram(o.filter(F.col("WeatherCode") == "view"), ["Temperature"], label="view")
    return a.unionByName(b)


PART_COLS = ["p_brand", "p_name", "p_type", "p_size"]


@register("distinct_counts", oracle=sql_norm("\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT \"{c}\") AS n_distinct FROM part" for c in PART_COLS),
    ints=["n_distinct"]))
def q_distinct_counts(spark, sf_dir):
    return profile.distinct_counts(ad.read(spark, sf_dir, "part"), PART_COLS)


PART_SCHEMA = [("p_partkey", "numeric", "bigint"), ("p_name", "categorical", "string"),
               ("p_brand", "categorical", "string"), ("p_type", "categorical", "string"),
               ("p_size", "numeric", "int"), ("p_retailprice", "numeric", "double")]


@register("column_profile", oracle=sql_norm("\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{k}' AS kind, '{t}' AS spark_type, count(\"{c}\") AS non_null, "
    f"count(DISTINCT \"{c}\") AS n_distinct FROM part" for i, (c, k, t) in enumerate(PART_SCHEMA)),
    ints=["position", "non_null", "n_distinct"]))
def q_column_profile(spark, sf_dir):
    return clean.column_profile(ad.read(spark, sf_dir, "part"))


@register("table_diff", oracle=sql_norm("""
SELECT * FROM (VALUES ('CloudType', 'only_right', NULL, 3, NULL), ('StationID', 'both', 1, 2, NULL),
                      ('Temperature', 'both', 2, 1, NULL), ('WeatherCode', 'only_left', 3, NULL, NULL),
                      ('event_id', 'both', 0, 0, NULL)) t("column", status, left_position, right_position, n_rows)
UNION ALL
SELECT '__rows_only_left__', 'rows', NULL, NULL, count(*) FROM (
  SELECT event_id, StationID, Temperature FROM obs_wide WHERE day <= 20
  EXCEPT ALL SELECT event_id, StationID, Temperature FROM obs_wide WHERE day >= 10)
UNION ALL
SELECT '__rows_only_right__', 'rows', NULL, NULL, count(*) FROM (
  SELECT event_id, StationID, Temperature FROM obs_wide WHERE day >= 10
  EXCEPT ALL SELECT event_id, StationID, Temperature FROM obs_wide WHERE day <= 20)""",
    ints=["left_position", "right_position", "n_rows"], with_=WIDE))
def q_table_diff(spark, sf_dir):
    o = ad.obs_wide(spark, sf_dir)
    a = o.filter(F.col("day") <= 20).select("event_id", "StationID", "Temperature", "WeatherCode")
    b = o.filter(F.col("day") >= 10).select("event_id", "Temperature", "StationID", "CloudType")
    return clean.table_diff(a, b)


@register("shape", oracle=sql_norm("SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem", ints=["n_rows", "n_columns"]))
def q_shape(spark, sf_dir):
    return profile.shape(ad.read(spark, sf_dir, "lineitem"))
