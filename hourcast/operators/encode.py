"""Robust scaling and categorical encoding fitted on train, applied to any frame.

Fitted state is a small DataFrame (one row per column, or per category), like a fitted encoder.
Applying it turns that schema-sized state into column expressions, or joins the label table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators.profile import to_long
from hourcast.operators.ranks import exact_quantiles, value_offsets
from hourcast.schema import categorical_columns, numeric_columns
from hourcast.session import cut_lineage

ONE_HOT_MAX = 10
UNSEEN = "unseen"


# ---- M4: robust scaling -------------------------------------------------------------------------------
def fit_robust_scaler(train: DataFrame, columns) -> DataFrame:
    """Per column: median and IQR (exact, linear interpolation); IQR 0 -> scale 1 (x - median)."""
    q = exact_quantiles(to_long(train, columns), ["column"], [0.25, 0.5, 0.75])
    w = q.groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")).withColumnsRenamed(
        {"0.25": "q1", "0.5": "median", "0.75": "q3"})
    iqr = F.col("q3") - F.col("q1")
    return w.select("column", "median", F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def apply_robust_scaler(df: DataFrame, fitted: DataFrame) -> DataFrame:
    params = {r["column"]: (r["median"], r["scale"]) for r in fitted.collect()}
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()
                           if c in df.columns and m is not None})


# ---- M5: one-hot / label encoding -----------------------------------------------------------------------
def fit_encoders(train: DataFrame, columns=None, one_hot_max: int = ONE_HOT_MAX, unseen_token: bool = False) -> DataFrame:
    """Fit table (column, kind, label, idx): ``kind`` 'onehot' for <= one_hot_max distinct values,
    else 'label'; ``idx`` is the 0-based position in sorted order (``unseen_token`` adds 'unseen'
    to the classes of label columns, as the tree pipeline does)."""
    cols = columns or categorical_columns(train.schema)
    long = to_long(train, cols, value_type="string")
    if unseen_token:
        spark = train.sparkSession
        extra = spark.createDataFrame([(c, UNSEEN) for c in cols], "column string, value string")
        long = long.unionByName(extra)
    idx = value_offsets(long, ["column"], distinct_only=True).select("column", F.col("value").alias("label"),
                                                                    F.col("less").alias("idx"))
    nd = idx.groupBy("column").agg(F.count(F.lit(1)).alias("_nd"))
    if unseen_token:
        # the added token does not count towards the one-hot rule
        real = to_long(train, cols, value_type="string").filter(F.col("value").isNotNull()).select(
            "column", "value").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("_nd"))
        nd = real
    fitted = idx.join(nd, "column").withColumn(
        "kind", F.when(F.col("_nd") <= one_hot_max, F.lit("onehot")).otherwise(F.lit("label"))).drop("_nd")
    if unseen_token:
        fitted = fitted.filter((F.col("kind") == "label") | (F.col("label") != UNSEEN))
    return fitted.select("column", "kind", "label", "idx")


def apply_encoders(df: DataFrame, fitted: DataFrame, unseen_token: bool = False, one_hot_type: str = "double") -> DataFrame:
    """One-hot columns become ``col_value`` of ``one_hot_type`` (unknown -> all 0); label columns become the
    class index (unknown -> -1, or the index of 'unseen' with ``unseen_token``).

    One-hot categories are at most ``ONE_HOT_MAX`` per column, so they are collected to build the
    expressions; label tables may be large and are joined (AQE broadcasts them when small).
    """
    onehot, label_cols, unseen = {}, [], {}
    state = fitted.groupBy("column", "kind").agg(F.collect_list(F.when(
        (F.col("kind") == "onehot") | (F.col("label") == UNSEEN), F.struct("idx", "label"))).alias("entries"))
    for r in state.collect():  # one row per column; at most ONE_HOT_MAX entries each
        if r["kind"] == "onehot":
            onehot[r["column"]] = [(e["idx"], e["label"]) for e in r["entries"]]
        else:
            label_cols.append(r["column"])
            unseen[r["column"]] = r["entries"][0]["idx"] if unseen_token and r["entries"] else -1
    out = df
    for c in [c for c in df.columns if c in label_cols]:
        t = fitted.filter((F.col("column") == c) & (F.col("kind") == "label")).select(
            F.col("label").alias(c), F.col("idx").alias("_idx"))
        out = out.withColumn(c, F.col(c).cast("string")).join(t, c, "left")
        out = out.withColumn(c, F.coalesce(F.col("_idx"), F.lit(unseen[c])).cast("long")).drop("_idx")
    order = list(out.columns)
    for c, cats in onehot.items():
        if c not in out.columns:
            continue
        new = {f"{c}_{lab}": F.when(F.col(c).cast("string") == F.lit(lab), F.lit(1)).otherwise(F.lit(0)).cast(one_hot_type)
               for _, lab in sorted(cats)}
        out = out.withColumns(new).drop(c)
        order = [x for x in order if x != c] + list(new)
    return out.select(*order)


def encode_splits(train: DataFrame, others: dict[str, DataFrame], columns=None, one_hot_type: str = "double") -> tuple[DataFrame, dict, DataFrame]:
    """M5 script variant: fit on train, apply to train and the others, align the others to train."""
    from hourcast.operators.clean import align_features
    fitted = cut_lineage(fit_encoders(train, columns))  # fitted once, applied to every frame
    tr = apply_encoders(train, fitted, one_hot_type=one_hot_type)
    return tr, {k: align_features(apply_encoders(v, fitted, one_hot_type=one_hot_type), tr.columns) for k, v in others.items()}, fitted
