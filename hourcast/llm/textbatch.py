"""Shared helpers of the text operators: UTF-8 views of Arrow batches, word spans, rolling fingerprints.

Everything here works on one Arrow batch inside a task; how rows reach the task is Spark's business.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20  # text handled at once inside a task; a longer single document is its own chunk

# Bytes that separate words in the contracts (space and 0x09-0x0D).
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_PRIME = (1 << 31) - 1
_BASE31 = 1_103_515_245


BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` texts, where the session still has Spark's default of 10,000 rows.

    A default batch holds tens of MB of text on both sides of each Python worker; tasks here cut batches into
    chunks of ``CHUNK_BYTES`` anyway.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def row_key(text: str = "text") -> Column:
    """Key that tells rows of one doc_id apart; rows equal in doc_id and text share it."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """``name`` for a helper column, with as many underscores in front as no column of ``df`` has (names differ beyond case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """The columns an operator uses, whatever else the table holds."""
    return df.select("doc_id", "text", *extra)


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the offset of each text (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library: nothing to call
        return None


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks and stages."""
    if _trim():
        _trim()(0)
    pa.default_memory_pool().release_unused()


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text each (a longer text comes alone)."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(start, end - start)
        start, done = end, int(size[end - 1])
    give_back()


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z; every other byte stays."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_table(separators) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


SPACE_WORDS = word_table(SPACE_BYTES)
#: bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and all of non-ASCII UTF-8
ALNUM_WORDS = word_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every maximal run of word bytes; runs end where a document ends."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    heads, tails = offsets[filled], offsets[filled + 1] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a base and of its inverse, modulo 2^64 or a prime, grown on demand."""

    def __init__(self, base: int, mod: int | None):
        self.mod = mod
        self.base = base
        self.inverse = pow(base, -1, mod or 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, have: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(have) < n:
            step = np.uint64(pow(base, len(have), self.mod or 1 << 64))
            more = have * step
            have = np.concatenate([have, more % np.uint64(self.mod) if self.mod else more])
        return have

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = self._grow(self.up, self.base, n), self._grow(self.down, self.inverse, n)
        return self.up, self.down


_P64, _P31 = _Powers(_BASE, None), _Powers(_BASE31, _PRIME)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Rolling:
    """Polynomial prefix sums of a sequence: a fingerprint of any span in constant time.

    Modulo 2^64; with ``strong`` also modulo the prime 2^31-1, which keeps bytes that are built to
    collide modulo a power of two apart.
    """

    def __init__(self, values: np.ndarray, strong: bool = False):
        n = len(values)
        up, self.down = _P64.get(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])
        self.strong = strong
        if strong:
            up31, self.down31 = _P31.get(n + 1)
            self.sums31 = np.zeros(n + 1, np.uint64)
            np.cumsum((values >> np.uint64(33)) * up31[:n] % np.uint64(_PRIME), out=self.sums31[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray, strong: bool = False) -> "Rolling":
        return cls(_BYTES[data], strong)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = self._sum64(starts, ends)
        return mix(h ^ mix(self._sum31(starts, ends) + np.uint64(1))) if self.strong else h

    def second_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Another fingerprint of the same spans, for ``strong`` sums: joins both sums (95 bits) in another way than ``spans``."""
        return mix(mix(self._sum64(starts, ends)) ^ mix(self._sum31(starts, ends) + np.uint64((1 << 32) + 1)))

    def _sum64(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def _sum31(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        p = np.uint64(_PRIME)
        return (self.sums31[ends] - self.sums31[starts]) % p * self.down31[starts] % p


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Rolling.of_bytes(data).spans(starts, ends) if len(starts) else np.zeros(0, np.uint64)


def by_document(doc: np.ndarray, n: int) -> np.ndarray:
    """First index of each document's items, for items in document order; n + 1 bounds."""
    return np.searchsorted(doc, np.arange(n + 1))
