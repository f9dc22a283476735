"""Time-ordered cuts and sliding samples.

Positions come from ``series.ordinal`` (per-day counts + prefix sums), never from one window over a
whole series, so a series holding a large share of all rows is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.operators.series import ordinal

SEQ_LEN = 336
HORIZON = 168


def with_positions(df: DataFrame, keys, order_col: str) -> DataFrame:
    """Add ``pos`` (1-based, time order) and ``n`` (rows in the series)."""
    return ordinal(df, keys, order_col, length_col="n")


def tail_split(df: DataFrame, keys, order_col: str, seq_len: int = SEQ_LEN, horizon: int = HORIZON) -> DataFrame:
    """Flags for train (all but the last seq_len + horizon rows), val (the last seq_len + horizon)
    and latest (the last seq_len); val and latest overlap by design."""
    p = with_positions(df, keys, order_col)
    from_end = F.col("n") - F.col("pos")  # 0 for the last row
    return p.withColumns({
        "in_train": from_end >= seq_len + horizon,
        "in_val": from_end < seq_len + horizon,
        "in_latest": from_end < seq_len,
    })


def tail_split_frames(df: DataFrame, keys, order_col: str, seq_len: int = SEQ_LEN,
                      horizon: int = HORIZON) -> dict[str, DataFrame]:
    t = tail_split(df, keys, order_col, seq_len, horizon)
    drop = ["pos", "n", "in_train", "in_val", "in_latest"]
    return {name: t.filter(F.col(f"in_{name}")).drop(*drop) for name in ("train", "val", "latest")}


def holdout_split(df: DataFrame, keys, order_col: str, test_len: int = 24, train_ratio: float = 0.8) -> DataFrame:
    """The last ``test_len`` rows are test; the rest is cut train / val at int(m * ratio)."""
    p = with_positions(df, keys, order_col)
    m = F.col("n") - F.lit(test_len)
    cut = F.floor(F.greatest(m, F.lit(0)) * F.lit(train_ratio))
    part = (F.when(F.col("pos") > m, F.lit("test")).when(F.col("pos") <= cut, F.lit("train"))
            .otherwise(F.lit("val")))
    return p.withColumn("split", part)


def recent_weeks(df: DataFrame, keys, order_col: str, block: int = 168) -> DataFrame:
    """Label the last ``block`` rows 'recent' and the ``block`` rows before them 'previous'."""
    p = with_positions(df, keys, order_col)
    from_end = F.col("n") - F.col("pos")
    lab = F.when(from_end < block, F.lit("recent")).when(from_end < 2 * block, F.lit("previous"))
    return p.withColumn("period", lab).filter(F.col("period").isNotNull())


def sliding_samples(df: DataFrame, keys, order_col: str, feature_cols, target_col: str,
                    seq_len: int = SEQ_LEN, horizon: int = HORIZON, stride: int = 1,
                    block_rows: int | None = None, dtype: str = "float") -> DataFrame:
    """One row per sample start s: ``x`` = features of rows s .. s+L-1 (array of arrays),
    ``y`` = target of rows s+L .. s+L+H-1. Samples per series = n - L - H + 1 (stride 1).

    Rows are cut into blocks of ``block_rows`` positions; the first L+H-1 rows of each block are
    also copied into the previous block, so every sample is complete inside one (key, block)
    window partition. Work per task is bounded by the block size, not by the series length.
    """
    keys = list(keys)
    total = seq_len + horizon
    block = block_rows or max(4 * total, 2048)
    if block < total - 1:
        raise ValueError("block_rows must be at least seq_len + horizon - 1")
    # A row belongs to its block, and the first rows of a block to the one before as well.
    blk = F.floor((F.col("pos") - 1) / block)
    near = (((F.col("pos") - 1) % block) < total - 1) & (blk > 0)
    p = ordinal(df, keys, order_col, length_col="_n").withColumn("_home", blk)
    p = p.withColumn("_vec", F.array(*[F.col(c).cast(dtype) for c in feature_cols])).withColumn(
        "_y", F.col(target_col).cast(dtype))
    u = (p.withColumn("_blk", F.explode(F.when(near, F.array(F.col("_home"), F.col("_home") - 1)).otherwise(F.array("_home"))))
         .withColumn("_own", F.col("_blk") == F.col("_home")).drop("_home"))
    w = Window.partitionBy(*keys, "_blk").orderBy("pos")
    out = u.select(
        *keys, "pos", "_n", "_own", F.col(order_col).alias("start_time"),
        F.collect_list("_vec").over(w.rowsBetween(0, seq_len - 1)).alias("x"),
        F.collect_list("_y").over(w.rowsBetween(seq_len, total - 1)).alias("y"),
        F.last(F.col(order_col)).over(w.rowsBetween(seq_len - 1, seq_len - 1)).alias("anchor_time"),
    )
    keep = F.col("_own") & (F.col("pos") <= F.col("_n") - total + 1)  # its window is complete
    if stride > 1:
        keep = keep & (((F.col("pos") - 1) % stride) == 0)
    return out.filter(keep).drop("_own", "_n").withColumnRenamed("pos", "start_pos")
