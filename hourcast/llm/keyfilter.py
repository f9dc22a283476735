"""A bit filter of fixed size over keys: it keeps rows that a join would drop anyway out of the join's shuffle.

The filter may let other keys pass, never stops one of its own, so an exact join on what passes gives the same
rows as a join of everything. Its size follows the number of keys up to ``FILTER_BITS`` and stays there: with more
keys it lets more rows pass, and the join does the work.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 26  # 8 MB


def filter_bits(keys: int, most: int = FILTER_BITS) -> int:
    """Bits of a filter for ``keys`` keys: at least 16 each, at most ``most``."""
    return min(most, 1 << max(16, (16 * keys).bit_length()))


class KeyFilter:
    """May a key be among ``keys``? False is certain. ``column`` asks in a plan; a task that runs Python on the rows anyway asks
    ``hit`` with a ``slot`` column and the broadcast ``mask``, so that it needs no second Python worker."""

    def __init__(self, keys: DataFrame, *cols: str, most: int = FILTER_BITS):
        self.bits = filter_bits(keys.count(), most)
        got = (keys.select(self.slot(*cols).alias("h")).select(F.shiftright("h", 6).alias("w"), F.pmod("h", F.lit(64)).cast("int").alias("b")).distinct()
               .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m")).toArrow())  # at most bits / 64 rows
        mask = np.zeros(self.bits >> 6, np.int64)
        mask[got.column("w").to_numpy()] = got.column("m").to_numpy()
        self.mask = keys.sparkSession.sparkContext.broadcast(mask)  # bits / 8 bytes

    def slot(self, *cols) -> Column:
        return F.pmod(F.xxhash64(*cols), F.lit(self.bits))

    def column(self, *cols) -> Column:
        mask = self.mask

        @F.pandas_udf("boolean")
        def maybe(h: pd.Series) -> pd.Series:
            return pd.Series(hit(mask.value, h.to_numpy()))

        return maybe(self.slot(*cols))


def hit(mask: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((mask[slots >> 6] >> (slots & 63)) & 1).astype(bool)


def maybe_in(keys: DataFrame, *cols: str, most: int = FILTER_BITS) -> Callable[..., Column]:
    """A function of columns like ``cols``: may this row's key be among ``keys``?"""
    return KeyFilter(keys, *cols, most=most).column
