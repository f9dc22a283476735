"""Rounding that gives the same digits whatever the summation order.

Means of decimal data often land exactly on a rounding tie (x.xx5), and floating sums taken in a
different order (other partitioning, other engine) tip them either way. ``stable_round`` first
snaps that noise away (round to 10 decimals), then rounds half-up with plain IEEE arithmetic.
``stable_round_sql`` is the same rule in SQL, for oracles.

Displayed values follow two other rules. ``round_scaled`` is the array rule (scale, round half to
even, scale back); ``round_exact`` rounds the exact binary value half to even, as Python's ``round``
and C's ``printf`` do. Both first snap summation noise away at 10 decimals.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_round(c, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    snapped = F.round(c, 10)
    fine = F.floor(snapped * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.isnan(c) | (F.abs(c) >= F.lit(1e12)), F.round(c, digits)).otherwise(fine) + F.lit(0.0)


def stable_round_sql(expr: str, digits: int) -> str:
    scale = f"{float(10 ** digits)}"
    x = f"CAST({expr} AS DOUBLE)"
    return (f"(CASE WHEN isnan({x}) OR abs({x}) >= 1e12 THEN round({x}, {digits}) "
            f"ELSE floor(round({x}, 10) * {scale} + 0.5) / {scale} END + 0.0)")


def null_if_nan(c) -> Column:
    """A value that is not a number is missing."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def round_scaled(c, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(10 ** digits))
    return F.rint(F.round(c, 10) * scale) / scale + F.lit(0.0)


def round_exact(c, digits: int) -> Column:
    """For summary-sized tables: an Arrow-batched UDF, since no built-in rounds the exact binary value."""
    c = F.col(c) if isinstance(c, str) else c

    @F.pandas_udf("double")
    def exact(x: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(v) else round(v, digits) + 0.0 for v in x], dtype="float64")

    return exact(F.round(c.cast("double"), 10))
