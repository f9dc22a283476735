"""Moments of every pair of columns from blocked matrix products (the base of A13, M1, M2).

Each task multiplies its Arrow batches: with values X (missing as 0, centred on the columns' means) and masks M, the
products M'M, X'M, (X*X)'M and X'X hold, for every pair, the number of complete rows and their sums. A task
gives one row for each pair, which are added up. The plan does not grow with the number of columns, and
the work on rows is a matrix product, not an expression for each pair.

Memory of a task is 6 * BLOCK^2 doubles: more columns are taken in pairs of blocks, a scan for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions.numeric import null_if_nan

BLOCK = 512
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
# A side varies if its variance is above rounding: of its mean square, and of the largest value of the column.
_VARIES, _STEP = 1e-14, 1e-13


def _value(c: str) -> Column:
    return null_if_nan(F.col(f"`{c}`").cast("double"))


def _block(df: DataFrame, columns: list[str], left: range, right: range, centre: dict[str, float]) -> DataFrame:
    """Sums of the pairs (i, j), i < j, with i in ``left`` and j in ``right`` (positions in ``columns``)."""
    here = [columns[i] for i in sorted({*left, *right})]
    at = {c: k for k, c in enumerate(here)}
    rows = df.select(*[(_value(c) - F.lit(centre[c])).alias(f"x{k}") for k, c in enumerate(here)])
    a, b = [at[columns[i]] for i in left], [at[columns[j]] for j in right]
    i1, i2 = (m.ravel() for m in np.meshgrid(np.array(left), np.array(right), indexing="ij"))
    upper = i1 < i2

    def multiply(batches):
        total = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) if batch.num_rows else np.zeros((0, len(here)))
            mask = ~np.isnan(x)
            x = np.where(mask, x, 0.0)
            m, xa, xb = mask.astype(np.float64), x[:, a], x[:, b]
            ma, mb = m[:, a], m[:, b]
            part = np.stack([ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in ((i1[upper], pa.int32()), (i2[upper], pa.int32()))] +
                                             [pa.array(s.ravel()[upper]) for s in total], names=["i1", "i2", *_SUMS])

    sums = rows.mapInArrow(multiply, "i1 int, i2 int, " + ", ".join(f"{s} double" for s in _SUMS))
    return sums.groupBy("i1", "i2").agg(*[F.sum(s).alias(s) for s in _SUMS])


def column_sums(df: DataFrame, columns, target: str, centre: float, block: int = BLOCK) -> DataFrame:
    """(f1, n, sx, sy, sxx, syy, sxy) of each column but ``target`` (the last one) with it, over the pair's complete rows, less ``centre``."""
    columns, sums = list(columns), None
    last = len(columns) - 1
    for i in range(0, last, block):
        part = _block(df, columns, range(i, min(i + block, last)), range(last, last + 1), dict.fromkeys(columns, centre))
        sums = part if sums is None else sums.unionByName(part)
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i1") + 1)
    return sums.select(name.alias("f1"), *_SUMS)


def pair_correlations(df: DataFrame, columns, block: int = BLOCK) -> DataFrame:
    """(f1, f2, i1, i2, r) for every pair of ``columns``, f1 before f2: Pearson r over the pair's complete rows.

    r is null where a side is constant over these rows, or no row is complete.
    """
    columns = list(columns)
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "f1 string, f2 string, i1 int, i2 int, r double")
    stats = df.agg(*[F.struct(F.avg(_value(c)).alias("mean"), F.max(F.abs(_value(c))).alias("top")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    finite = lambda v: v if v is not None and np.isfinite(v) else 0.0
    centre = {c: finite(s["mean"]) for c, s in zip(columns, stats)}
    top = [finite(s["top"]) for s in stats]
    blocks = [range(i, min(i + block, len(columns))) for i in range(0, len(columns), block)]
    sums = None
    for p, left in enumerate(blocks):
        for right in blocks[p:]:
            part = _block(df, columns, left, right, centre)
            sums = part if sums is None else sums.unionByName(part)
    n = F.col("n")

    def variance(total: str, squares: str, i: str) -> Column:
        mean_square = F.col(squares) / n
        v = mean_square - F.pow(F.col(total) / n, 2)
        step = F.element_at(F.array(*[F.lit(t * _STEP) for t in top]), F.col(i) + 1)
        return F.when((v > mean_square * _VARIES) & (v > step * step), v)

    cov = F.col("sxy") / n - F.col("sx") / n * F.col("sy") / n
    r = F.when(n > 0, cov / (F.sqrt(variance("sx", "sxx", "i1")) * F.sqrt(variance("sy", "syy", "i2"))))
    name = lambda i: F.element_at(F.array(*[F.lit(c) for c in columns]), F.col(i) + 1)
    limited = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))
    return sums.select(name("i1").alias("f1"), name("i2").alias("f2"), "i1", "i2", F.when(r.isNotNull(), limited).alias("r"))
