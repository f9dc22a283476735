"""Wave 5 queries: tail split, holdout split, sliding samples, robust scaling, one-hot / label
encoding, feature alignment, last-week comparison."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hourcast.operators import advise, clean, encode, split
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import register, sql_norm
from hourcast.session_paths import scratch, tag
from hourcast.sources import files

HOURLY = ad.with_ctes("obs_hourly")
WIDE = ad.with_ctes("obs_wide")
KEYS = ["StationID"]
POS_SQL = """SELECT *, row_number() OVER (PARTITION BY StationID ORDER BY ObservationTime) AS pos,
       count(*) OVER (PARTITION BY StationID) AS n FROM obs_hourly"""


@register("time_split", oracle=sql_norm(f"""SELECT StationID, ObservationTime, pos, n,
       n - pos >= 504 AS in_train, n - pos < 504 AS in_val, n - pos < 336 AS in_latest FROM ({POS_SQL})""",
    ints=["pos", "n"], ts=["ObservationTime"], with_=HOURLY))
def q_time_split(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir).select("StationID", "ObservationTime", "Temperature")
    t = split.tail_split(h, KEYS, "ObservationTime", 336, 168)
    return t.select("StationID", "ObservationTime", "pos", "n", "in_train", "in_val", "in_latest")


@register("holdout_split", oracle=sql_norm(f"""SELECT StationID, ObservationTime, pos, n,
       CASE WHEN pos > n - 24 THEN 'test' WHEN pos <= floor(greatest(n - 24, 0) * 0.8) THEN 'train' ELSE 'val' END AS split
FROM ({POS_SQL})""", ints=["pos", "n"], ts=["ObservationTime"], with_=HOURLY))
def q_holdout_split(spark, sf_dir):
    h = ad.obs_hourly(spark, sf_dir).select("StationID", "ObservationTime")
    return split.holdout_split(h, KEYS, "ObservationTime", 24, 0.8).select("StationID", "ObservationTime", "pos", "n", "split")


L, H = 24, 12


@register("windows", oracle=sql_norm(f"""SELECT StationID, pos AS start_pos, ObservationTime AS start_time, anchor_time, n_x, n_y, x_sum, y_sum, y_first, y_last
FROM (SELECT StationID, ObservationTime, pos,
        count(*) OVER w_x AS n_x, count(*) OVER w_y AS n_y,
        sum(Temperature + n_events) OVER w_x AS x_sum, sum(Temperature) OVER w_y AS y_sum,
        first_value(Temperature) OVER w_y AS y_first, last_value(Temperature) OVER w_y AS y_last,
        last_value(ObservationTime) OVER w_x AS anchor_time
      FROM ({POS_SQL})
      WINDOW w_x AS (PARTITION BY StationID ORDER BY pos ROWS BETWEEN CURRENT ROW AND {L - 1} FOLLOWING),
             w_y AS (PARTITION BY StationID ORDER BY pos ROWS BETWEEN {L} FOLLOWING AND {L + H - 1} FOLLOWING))
WHERE n_x = {L} AND n_y = {H}""",
    doubles=["x_sum", "y_sum", "y_first", "y_last"], ints=["start_pos", "n_x", "n_y"], ts=["start_time", "anchor_time"],
    with_=HOURLY))
def q_windows(spark, sf_dir):
    """W4 with L=24, H=12 and small blocks (100 rows) so samples cross block edges; the check
    summarises each sample's arrays."""
    h = ad.obs_hourly(spark, sf_dir)
    s = split.sliding_samples(h, KEYS, "ObservationTime", ["Temperature", "n_events"], "Temperature",
                              seq_len=L, horizon=H, block_rows=100, dtype="double")
    return s.select("StationID", "start_pos", "start_time", "anchor_time",
                    F.size("x").alias("n_x"), F.size("y").alias("n_y"),
                    F.aggregate(F.transform("x", lambda r: r[0] + r[1]), F.lit(0.0), lambda a, b: a + b).alias("x_sum"),
                    F.aggregate("y", F.lit(0.0), lambda a, b: a + b).alias("y_sum"),
                    F.element_at("y", 1).alias("y_first"), F.element_at("y", -1).alias("y_last"))


SCALE_COLS = ["WindSpeed", "LocalPressure", "GustTime", "Visibility"]


@register("robust_scale", oracle=sql_norm(
    "SELECT event_id, " + ", ".join(
        f'("{c}" - (SELECT quantile_cont("{c}", 0.5) FROM obs_wide WHERE day <= 20)) / '
        f'(SELECT CASE WHEN quantile_cont("{c}", 0.75) - quantile_cont("{c}", 0.25) = 0 THEN 1.0 '
        f'ELSE quantile_cont("{c}", 0.75) - quantile_cont("{c}", 0.25) END FROM obs_wide WHERE day <= 20) AS "{c}"'
        for c in SCALE_COLS) + ", Temperature FROM obs_wide",
    doubles=SCALE_COLS + ["Temperature"], ints=["event_id"], with_=WIDE))
def q_robust_scale(spark, sf_dir):
    """M4: fit median / IQR on the first 20 days, apply to all rows; the target is not scaled."""
    w = ad.obs_wide(spark, sf_dir).select("event_id", "day", "Temperature", *SCALE_COLS)
    fitted = encode.fit_robust_scaler(w.filter(F.col("day") <= 20), SCALE_COLS)
    return encode.apply_robust_scaler(w, fitted).drop("day")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


@register("one_hot", oracle=sql_norm(
    "SELECT o_orderkey, o_totalprice, " + ", ".join(
        [f"CASE WHEN o_orderpriority = '{v}' THEN 1.0 ELSE 0.0 END AS \"o_orderpriority_{v}\"" for v in PRIORITIES]
        + [f"CASE WHEN o_orderstatus = '{v}' THEN 1.0 ELSE 0.0 END AS \"o_orderstatus_{v}\"" for v in STATUSES])
    + " FROM orders",
    doubles=["o_totalprice"] + [f"o_orderpriority_{v}" for v in PRIORITIES] + [f"o_orderstatus_{v}" for v in STATUSES],
    ints=["o_orderkey"]))
def q_one_hot(spark, sf_dir):
    """M5 (<= 10 categories): fit on orders before 1999, apply to every order."""
    o = ad.read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus", "o_orderdate")
    fitted = encode.fit_encoders(o.filter(F.col("o_orderdate") < "1999-01-01"), ["o_orderpriority", "o_orderstatus"])
    return encode.apply_encoders(o.drop("o_orderdate"), fitted)


def _label_sql(col: str, train_where: str, unseen: bool = False) -> str:
    classes = f"SELECT DISTINCT {col} AS label FROM part WHERE {train_where}"
    if unseen:
        classes = f"{classes} UNION SELECT 'unseen'"
    return (f"(SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx FROM ({classes}))")


@register("label_index", oracle=sql_norm(f"""SELECT p.p_partkey, coalesce(b.idx, -1) AS p_brand, coalesce(n.idx, -1) AS p_name,
  {", ".join(f"CASE WHEN p.p_type = '{v}' THEN 1.0 ELSE 0.0 END AS \"p_type_{v}\"" for v in sorted(['STANDARD', 'MEDIUM', 'PROMO', 'LARGE', 'SMALL', 'ECONOMY']))}
FROM part p LEFT JOIN {_label_sql('p_brand', 'p_size <= 40')} b ON p.p_brand = b.label
            LEFT JOIN {_label_sql('p_name', 'p_size <= 40')} n ON p.p_name = n.label""",
    doubles=[f"p_type_{v}" for v in sorted(['STANDARD', 'MEDIUM', 'PROMO', 'LARGE', 'SMALL', 'ECONOMY'])],
    ints=["p_partkey", "p_brand", "p_name"]))
def q_label_index(spark, sf_dir):
    """M5 + J4 (> 10 categories -> sorted label index, unseen -> -1); fit on parts of size <= 40."""
    p = ad.read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type", "p_size")
    fitted = encode.fit_encoders(p.filter(F.col("p_size") <= 40), ["p_brand", "p_name", "p_type"])
    return encode.apply_encoders(p.drop("p_size"), fitted)


@register("label_index_unseen", oracle=sql_norm(f"""SELECT p.p_partkey,
  coalesce(b.idx, (SELECT idx FROM {_label_sql('p_brand', 'p_size <= 10', True)} WHERE label = 'unseen')) AS p_brand
FROM part p LEFT JOIN {_label_sql('p_brand', 'p_size <= 10', True)} b ON p.p_brand = b.label""",
    ints=["p_partkey", "p_brand"]))
def q_label_index_unseen(spark, sf_dir):
    """M5 tree-pipeline variant: classes include 'unseen', unknown labels map to it."""
    p = ad.read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    fitted = encode.fit_encoders(p.filter(F.col("p_size") <= 10), ["p_brand"], unseen_token=True)
    return encode.apply_encoders(p.drop("p_size"), fitted, unseen_token=True)


@register("align_features", oracle=sql_norm(
    "SELECT o_orderkey, " + ", ".join(
        [f"CASE WHEN o_orderpriority = '{v}' THEN 1.0 ELSE 0.0 END AS \"o_orderpriority_{v}\"" for v in PRIORITIES[:-1]]
        + ["0 AS \"o_orderpriority_5-LOW\"", "0 AS extra_flag"]) + " FROM orders WHERE o_orderpriority <> '5-LOW'",
    doubles=[f"o_orderpriority_{v}" for v in PRIORITIES[:-1]], ints=["o_orderkey", "extra_flag", "o_orderpriority_5-LOW"]))
def q_align_features(spark, sf_dir):
    """A frame encoded on its own (no '5-LOW' rows, an extra column) aligned to the train
    layout: missing one-hot columns added as 0, extras dropped, order fixed."""
    o = ad.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    train = encode.apply_encoders(o, encode.fit_encoders(o, ["o_orderpriority"]))
    part = o.filter(F.col("o_orderpriority") != "5-LOW")
    other = encode.apply_encoders(part, encode.fit_encoders(part, ["o_orderpriority"])).withColumn("junk", F.lit(1))
    return clean.align_features(other, train.columns + ["extra_flag"])


@register("week_compare", oracle=sql_norm("""
SELECT a.StationID, a.hour, a.Predicted, b.Actual_Recent, c.Actual_Prev FROM
 (SELECT StationID, hour, avg(pred_Temperature) AS Predicted FROM forecast GROUP BY 1, 2) a
 JOIN (SELECT StationID, hour, avg(Temperature) AS Actual_Recent FROM (SELECT *, count(*) OVER (PARTITION BY StationID) - row_number() OVER (PARTITION BY StationID ORDER BY ObservationTime) AS fe FROM obs_hourly) WHERE fe < 168 GROUP BY 1, 2) b
   ON a.StationID = b.StationID AND a.hour = b.hour
 JOIN (SELECT StationID, hour, avg(Temperature) AS Actual_Prev FROM (SELECT *, count(*) OVER (PARTITION BY StationID) - row_number() OVER (PARTITION BY StationID ORDER BY ObservationTime) AS fe FROM obs_hourly) WHERE fe >= 168 AND fe < 336 GROUP BY 1, 2) c
   ON a.StationID = c.StationID AND a.hour = c.hour""",
    doubles=["Predicted", "Actual_Recent", "Actual_Prev"], ints=["hour"], with_=ad.with_ctes("forecast")))
def q_week_compare(spark, sf_dir):
    """W7 + A3 + J2: hourly means of the forecast, the last 168 rows and the 168 rows before."""
    fc = ad.forecast(spark, sf_dir)
    h = ad.obs_hourly(spark, sf_dir)
    wk = split.recent_weeks(h, KEYS, "ObservationTime", 168)
    pred = fc.groupBy("StationID", "hour").agg(F.avg("pred_Temperature").alias("Predicted"))
    rec = wk.filter(F.col("period") == "recent").groupBy("StationID", "hour").agg(F.avg("Temperature").alias("Actual_Recent"))
    prev = wk.filter(F.col("period") == "previous").groupBy("StationID", "hour").agg(F.avg("Temperature").alias("Actual_Prev"))
    return advise.compare_hourly({"pred": pred, "recent": rec, "prev": prev}, ["StationID", "hour"])


@register("split_write", oracle=sql_norm(f"""SELECT 'val' AS split_name, StationID, count(*) AS n_rows FROM ({POS_SQL}) WHERE n - pos < 504 GROUP BY 2
UNION ALL SELECT 'latest', StationID, count(*) FROM ({POS_SQL}) WHERE n - pos < 336 GROUP BY 2
UNION ALL SELECT 'train', StationID, count(*) FROM ({POS_SQL}) WHERE n - pos >= 504 GROUP BY 2""",
    ints=["n_rows"], with_=HOURLY))
def q_split_write(spark, sf_dir):
    """S11 + P5: write train / val / latest run-stamped (time parts dropped), read back the counts."""
    h = ad.obs_hourly(spark, sf_dir)
    parts = {k: clean.drop_time_parts(v) for k, v in split.tail_split_frames(h, KEYS, "ObservationTime").items()}
    root = files.write_splits(parts, scratch(spark, "splits", tag(sf_dir)), "20240131_0000")
    d = spark.read.parquet(root)
    return d.groupBy(F.col("split").alias("split_name"), "StationID").agg(F.count(F.lit(1)).alias("n_rows"))


@register("split_write_values", oracle=sql_norm(f"""SELECT * FROM (
  SELECT 'val' AS split_name, StationID, ObservationTime, Temperature, n_events, '' AS time_parts FROM ({POS_SQL}) WHERE n - pos < 504
  UNION ALL SELECT 'latest', StationID, ObservationTime, Temperature, n_events, '' FROM ({POS_SQL}) WHERE n - pos < 336
  UNION ALL SELECT 'train', StationID, ObservationTime, Temperature, n_events, '' FROM ({POS_SQL}) WHERE n - pos >= 504)""",
    doubles=["Temperature"], ints=["n_events"], ts=["ObservationTime"], with_=HOURLY))
def q_split_write_values(spark, sf_dir):
    """S11 + P5: every written row read back, and the names of the time parts that are still there (none)."""
    h = ad.obs_hourly(spark, sf_dir)
    parts = {k: clean.drop_time_parts(v) for k, v in split.tail_split_frames(h, KEYS, "ObservationTime").items()}
    d = spark.read.parquet(files.write_splits(parts, scratch(spark, "split_values", uuid.uuid4().hex[:12]), "20240131_0000"))
    left = ",".join(c for c in d.columns if c in ("year", "month", "day", "hour"))
    return d.select(F.col("split").alias("split_name"), "StationID", "ObservationTime", "Temperature", "n_events", F.lit(left).alias("time_parts"))
