"""Variants of profiling, correlation, encoding, scaling and source operators: gaps, NaN, text columns, rejects,
integer one-hot, an hour-partitioned CSV lake, and scaled cyclic columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hourcast.operators import encode, profile
from hourcast.operators import significance as st
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import printed, register, sql_norm
from hourcast.session_paths import scratch
from hourcast.sources import files, text

WIDE = ad.with_ctes("obs_wide")
GAP_FEATS = ["Temperature", "GustTime", "WindSpeed", "SnowDepth3Hr"]
TEXT = ["StationID", "WeatherCode", "CloudType"]


def _pairs_sql(rank: bool) -> str:
    out = []
    for i, a in enumerate(GAP_FEATS):
        for j, b in enumerate(GAP_FEATS):
            if i < j:
                src = f'SELECT CAST("{a}" AS DOUBLE) AS x, CAST("{b}" AS DOUBLE) AS y FROM obs_wide WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL'
                if rank:
                    avg = lambda v: f"(rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / 2.0)"
                    src = f"SELECT {avg('x')} AS x, {avg('y')} AS y FROM ({src})"
                out.append(f"""SELECT '{a}' AS f1, '{b}' AS f2, {i} AS i1, {j} AS i2,
  covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS r FROM ({src})""")
    return sql_norm("\nUNION ALL ".join(out), doubles=["r"], ints=["i1", "i2"], with_=WIDE)


@register("corr_pairs_nulls", oracle=_pairs_sql(False))
def q_corr_pairs_nulls(spark, sf_dir):
    """A13 over complete pairs: one column with gaps, one without any value."""
    return st.corr_matrix(ad.obs_wide(spark, sf_dir), GAP_FEATS)


@register("corr_pairs_spearman_nulls", oracle=_pairs_sql(True))
def q_corr_pairs_spearman_nulls(spark, sf_dir):
    """A13 by ranks of each pair's complete rows."""
    return st.corr_matrix(ad.obs_wide(spark, sf_dir), GAP_FEATS, "spearman")


# A value that is no number in every 7th row.
NAN_SQL = "SELECT CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_quantity AS DOUBLE) END AS q, CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_extendedprice AS DOUBLE) END AS p FROM lineitem"


def _with_nan(spark, sf_dir):
    li = ad.read(spark, sf_dir, "lineitem")
    value = lambda c: F.when(F.col("l_orderkey") % 7 != 0, F.col(c).cast("double")).otherwise(F.lit(float("nan")))
    return li.select(value("l_quantity").alias("q"), value("l_extendedprice").alias("p"))


@register("describe_nan", oracle=sql_norm("\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM ({NAN_SQL})""" for c in ("q", "p")),
    doubles=["mean", "std", "min", "p25", "p50", "p75", "max"], ints=["count"]))
def q_describe_nan(spark, sf_dir):
    """A9 where NaN is missing."""
    return profile.describe(_with_nan(spark, sf_dir), ["q", "p"])


@register("iqr_outliers_nan", oracle=sql_norm("\nUNION ALL ".join(
    f"""SELECT '{c}' AS "Column", count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS "Outlier Count",
  {printed(f'count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count(*) * 100', 3)} AS "Outlier Ratio (%)"
  FROM ({NAN_SQL}), (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM ({NAN_SQL}))""" for c in ("q", "p")),
    doubles=["Outlier Ratio (%)"], ints=["Outlier Count"]))
def q_iqr_outliers_nan(spark, sf_dir):
    """A10 where NaN is no outlier."""
    return profile.outlier_iqr(_with_nan(spark, sf_dir), ["q", "p"])


@register("histogram_nan", oracle=sql_norm(f"""
SELECT 'p' AS "column", b + 1 AS bin, lo + (hi - lo) * b / 30 AS bin_low, lo + (hi - lo) * (b + 1) / 30 AS bin_high, count(*) AS count
FROM (SELECT lo, hi, least(CAST(floor((p - lo) / (hi - lo) * 30) AS BIGINT), 29) AS b
      FROM ({NAN_SQL}), (SELECT min(p) AS lo, max(p) AS hi FROM ({NAN_SQL})) WHERE p IS NOT NULL) GROUP BY lo, hi, b""",
    doubles=["bin_low", "bin_high"], ints=["bin", "count"]))
def q_histogram_nan(spark, sf_dir):
    """A16 where NaN is in no bin."""
    return profile.histogram(_with_nan(spark, sf_dir), ["p"])


@register("describe_all", oracle=sql_norm("\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", sum(n) AS count, count(*) AS "unique", min_by(v, (-n, v)) AS top, max(n) AS freq
  FROM (SELECT "{c}" AS v, count(*) AS n FROM obs_wide WHERE "{c}" IS NOT NULL GROUP BY 1)""" for c in TEXT), ints=["count", "unique", "freq"], with_=WIDE))
def q_describe_all(spark, sf_dir):
    """A9 of text columns: count, distinct values, the most frequent one and how often it stands there."""
    df = ad.obs_wide(spark, sf_dir).select(*TEXT, "Temperature")
    return profile.describe_all(df).where(F.col("column") != "Temperature").select("column", "count", "unique", "top", "freq")


@register("parse_rejects", oracle=sql_norm("""
SELECT n_fields, count(*) AS n_lines, sum(event_id) AS ids FROM (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 45 ELSE 3 END AS n_fields FROM events WHERE event_id % 5 IN (0, 1)) GROUP BY 1""",
    ints=["n_fields", "n_lines", "ids"]))
def q_parse_rejects(spark, sf_dir):
    """Lines with too few fields go to the rejects frame; whole lines and comments don't."""
    e = ad.read(spark, sf_dir, "events")
    short = F.concat_ws(" ", F.col("event_id").cast("string"), F.array_join(F.array_repeat(F.lit("1"), 44), " "))
    line = (F.when(F.col("event_id") % 5 == 0, short).when(F.col("event_id") % 5 == 1, F.concat(F.col("event_id").cast("string"), F.lit("  a\tb")))
            .when(F.col("event_id") % 5 == 2, F.lit("# a comment line"))
            .otherwise(F.array_join(F.array_repeat(F.lit("202401010000"), 46), " ")))
    _, rejects = text.parse_observation_lines(e.select(line.alias("value")))
    return rejects.groupBy("n_fields").agg(F.count(F.lit(1)).alias("n_lines"),
                                           F.sum(F.split("line", r"\s+")[0].cast("bigint")).alias("ids"))


@register("one_hot_int", oracle=sql_norm("""
SELECT o_orderkey, """ + ", ".join(f"CAST(o_orderstatus = '{s}' AS INTEGER) AS \"o_orderstatus_{s}\"" for s in "FOP") + " FROM orders",
    ints=["o_orderkey", "o_orderstatus_F", "o_orderstatus_O", "o_orderstatus_P"]))
def q_one_hot_int(spark, sf_dir):
    """M5 as the tree pipeline writes it: integer one-hot columns."""
    o = ad.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return encode.apply_encoders(o, encode.fit_encoders(o, ["o_orderstatus"]), one_hot_type="int")


@register("hourly_csv_lake", oracle=sql_norm("""
SELECT day, hour, count(*) AS n_rows, sum(Temperature) AS sum_temp FROM obs_wide WHERE day <= 5 GROUP BY 1, 2""",
    doubles=["sum_temp"], ints=["day", "hour", "n_rows"], with_=WIDE))
def q_hourly_csv_lake(spark, sf_dir):
    """S14 as a lake of year / month / day / hour folders of CSV files, read back by partition discovery and pruned."""
    root = scratch(spark, "csv_lake", uuid.uuid4().hex[:12])
    obs = ad.obs_wide(spark, sf_dir).select("StationID", "ObservationTime", "Temperature", "year", "month", "day", "hour")
    files.write_csv_lake(obs, root)
    d = files.read_csv_lake(spark, root, obs.drop("year", "month", "day", "hour").schema).where("day <= 5")
    return d.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("Temperature").alias("sum_temp"))


@register("scale_cyclic", oracle=sql_norm("""
WITH c AS (SELECT event_id, sin(2 * pi() * CAST(hour AS DOUBLE) / 24) AS s, cos(2 * pi() * CAST(hour AS DOUBLE) / 24) AS c FROM obs_wide),
q AS (SELECT quantile_cont(s, 0.5) AS sm, quantile_cont(s, 0.75) - quantile_cont(s, 0.25) AS sq, quantile_cont(c, 0.5) AS cm, quantile_cont(c, 0.75) - quantile_cont(c, 0.25) AS cq FROM c)
SELECT event_id, (s - sm) / CASE WHEN sq = 0 THEN 1 ELSE sq END AS hour_sin, (c - cm) / CASE WHEN cq = 0 THEN 1 ELSE cq END AS hour_cos FROM c, q"""
    .replace("WITH c AS", "SELECT * FROM (WITH c AS", 1) + ")", doubles=["hour_sin", "hour_cos"], ints=["event_id"], with_=WIDE))
def q_scale_cyclic(spark, sf_dir):
    """M4 with the cyclic columns scaled as well (an option of the preparation chain)."""
    df = ad.obs_wide(spark, sf_dir)
    angle = F.lit(2 * 3.141592653589793) * F.col("hour").cast("double") / 24
    df = df.select("event_id", F.sin(angle).alias("hour_sin"), F.cos(angle).alias("hour_cos"))
    return encode.apply_robust_scaler(df, encode.fit_robust_scaler(df, ["hour_sin", "hour_cos"]))
