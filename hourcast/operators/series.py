"""Series operators over (series key, time) ordered data: positions, lags, leads, back-fill.

A naive ``Window.partitionBy(station).orderBy(time)`` sends a whole station to one task; a station
may hold a large share of all rows. These operators therefore work in two levels:

1. rows are cut into time buckets (default: the calendar day of the order column);
2. per (key, bucket) counts / first values form a small table (keys x buckets) whose running sums
   over buckets give each bucket's offset;
3. row-level work happens inside (key, bucket) partitions, or as equi-joins on (key, position),
   which spread evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _day_bucket(order_col: str) -> Column:
    return F.to_date(F.col(order_col))


def ordinal(df: DataFrame, keys, order_col: str, pos_col: str = "pos", bucket: Column | None = None,
            tiebreak=(), length_col: str | None = None) -> DataFrame:
    """Add a 1-based position per ``keys`` ordered by ``order_col`` (then ``tiebreak``).

    ``length_col`` also adds the rows of the series, from the same (keys, bucket) table: no join of
    rows on the series key alone.

    Equal to ``row_number().over(partitionBy(keys).orderBy(order_col, *tiebreak))`` without putting a
    key's rows into one task.
    """
    keys = list(keys)
    b = df.withColumn("_bk", bucket if bucket is not None else _day_bucket(order_col))
    counts = b.groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    w_prev = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bk", F.coalesce(F.sum("_n").over(w_prev), F.lit(0)).alias("_off"),
                            *([F.sum("_n").over(Window.partitionBy(*keys)).alias(length_col)] if length_col else []))
    w_in = Window.partitionBy(*keys, "_bk").orderBy(F.col(order_col), *[F.col(t) for t in tiebreak])
    b = b.withColumn("_rn", F.row_number().over(w_in))
    out = b.join(offsets, keys + ["_bk"])
    return out.withColumn(pos_col, (F.col("_off") + F.col("_rn")).cast("long")).drop("_bk", "_off", "_rn")


def series_length(df: DataFrame, keys, n_col: str = "n") -> DataFrame:
    """Rows per series (partial aggregation; hot keys are combined map-side)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_col))


def lag_by_position(df: DataFrame, keys, pos_col: str, cols, lag: int, suffix: str | None = None) -> DataFrame:
    """Value ``lag`` rows earlier in the same series (``lag`` < 0 looks ahead).

    Equi-join on (keys, position): one shuffle per side, evenly spread, no per-key task.
    """
    keys = list(keys)
    suffix = suffix or f"_lag{lag}"
    prev = df.select(*keys, (F.col(pos_col) + F.lit(lag)).alias(pos_col),
                     *[F.col(c).alias(c + suffix) for c in cols])
    return df.join(prev, keys + [pos_col], "left")


def lag_by_time(df: DataFrame, keys, time_col: str, cols, hours: int, suffix: str | None = None) -> DataFrame:
    """Gap-safe lag: the value observed exactly ``hours`` earlier (null if that hour is missing)."""
    keys = list(keys)
    suffix = suffix or f"_t{hours}h"
    prev = df.select(*keys, (F.col(time_col) + F.expr(f"INTERVAL {hours} HOURS")).alias(time_col),
                     *[F.col(c).alias(c + suffix) for c in cols])
    return df.join(prev, keys + [time_col], "left")


def diff_by_position(df: DataFrame, keys, pos_col: str, col: str, lag: int = 24, out: str | None = None) -> DataFrame:
    """``col - col`` of ``lag`` rows earlier (pandas ``diff(lag)`` on the time-ordered series)."""
    out = out or f"{col}_diff{lag}"
    j = lag_by_position(df, keys, pos_col, [col], lag, "__prev")
    return j.withColumn(out, F.col(col) - F.col(col + "__prev")).drop(col + "__prev")


def diff_by_time(df: DataFrame, keys, time_col: str, col: str, hours: int = 24, out: str | None = None) -> DataFrame:
    """W1 gap-safe: ``col`` minus the value exactly ``hours`` earlier."""
    out = out or f"{col}_diff{hours}h"
    j = lag_by_time(df, keys, time_col, [col], hours, "__prev")
    return j.withColumn(out, F.col(col) - F.col(col + "__prev")).drop(col + "__prev")


def backfill(df: DataFrame, keys, order_col: str, cols, bucket: Column | None = None, tiebreak=()) -> DataFrame:
    """Replace each null with the next non-null value of the same series (pandas ``bfill``).

    Level 1 fills inside (key, bucket); level 2 takes, per bucket, the first non-null value of the
    later buckets from a small (keys x buckets) table and fills what is still null. ``tiebreak`` orders rows of one time.

    Both windows run from the last row to the first: "the next value" is then the last one seen, a running frame that
    reads each row once. A frame that ends at the last row is scanned anew for each row: quadratic in a bucket's rows.
    """
    keys = list(keys)
    b = df.withColumn("_bk", bucket if bucket is not None else _day_bucket(order_col))
    order = [F.col(c) for c in (order_col, *tiebreak)]
    w_in = Window.partitionBy(*keys, "_bk").orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w_in) for c in cols})
    # first non-null value of each bucket (min_by on the order over non-null rows)
    firsts = b.groupBy(*keys, "_bk").agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_f_{c}") for c in cols])
    w_next = Window.partitionBy(*keys).orderBy(F.desc("_bk")).rowsBetween(Window.unboundedPreceding, -1)
    carry = firsts.select(*keys, "_bk", *[F.last(F.col(f"_f_{c}"), ignorenulls=True).over(w_next).alias(f"_c_{c}")
                                          for c in cols])
    out = b.join(carry, keys + ["_bk"], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_c_{c}")) for c in cols}).drop(
        "_bk", *[f"_c_{c}" for c in cols])


def next_value_by_position(df: DataFrame, keys, pos_col: str, cols, steps: int = 1) -> DataFrame:
    """Value ``steps`` rows later in the series (``lead``)."""
    return lag_by_position(df, keys, pos_col, cols, -steps, f"_next{steps}")


def next_value_by_time(df: DataFrame, keys, time_col: str, cols, hours: int = 1) -> DataFrame:
    """W8 gap-safe: value observed exactly ``hours`` later."""
    return lag_by_time(df, keys, time_col, cols, -hours, f"_next{hours}h")
