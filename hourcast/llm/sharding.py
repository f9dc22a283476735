"""Sharding by histogram sort: splitters are found by counting bytes below candidate keys, then one exchange.

Documents are ordered by a 63-bit key: 39 bits of the text's hash and 24 bits of the row's, so equal texts lie
together and a group of copies of any size can still be cut. The key range is to be cut into ``shards * parts``
pieces of equal bytes. Every round counts, across all partitions, the exact bytes and rows below a few candidate
keys between the known bounds of each splitter; the bounds close in until a splitter meets the tolerance or no
key lies between. Each round moves a fixed number of counts. Then rows are exchanged once, by piece, and take
their slot from the rows before their piece and their place within it.

Defined cases: a null or empty text has size 1. Repeated rows, null ids and equal keys have places in the
order of (key, doc_id, text hash); rows equal in all of these are interchangeable. An empty table gives an
empty result. A row larger than a shard makes sizes differ by that row. Further columns stay, whatever their
names; columns named shard or slot are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.session import cut_lineage

SHARDS = 16
PROBES = 15  # candidate keys between the bounds of a splitter
TOLERANCE = 0.001  # of a piece's bytes
KEY_BITS = 63
MAX_ROUNDS = 32


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with __key, __tie and __size."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.xxhash64(F.col("doc_id"), F.lit(1))
    key = F.shiftrightunsigned(F.xxhash64(text), 25).bitwiseAND(F.lit((1 << 39) - 1))
    return docs.withColumns({"__key": F.shiftleft(key, 24).bitwiseOR(own.bitwiseAND(F.lit((1 << 24) - 1))), "__tie": F.xxhash64(text),
                             "__size": (F.octet_length(text) + 1).cast("bigint")})


def _below(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe (sorted, distinct)."""
    known = rows.sparkSession.sparkContext.broadcast(probes)  # at most PROBES for each splitter

    def run(batches):
        total = np.zeros((2, len(known.value) + 1), np.int64)
        for b in batches:
            at = np.searchsorted(known.value, b.column("__key").to_numpy(), side="right")
            np.add.at(total[0], at, b.column("__size").to_numpy())
            np.add.at(total[1], at, 1)
        some = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], names=["i", "bytes", "n"])

    got = rows.select("__key", "__size").mapInArrow(run, "i bigint, bytes bigint, n bigint").groupBy("i").agg(
        F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    out = np.zeros((2, len(probes) + 1), np.int64)
    for r in got:
        out[:, r["i"]] = r["bytes"], r["n"]
    return np.cumsum(out[0])[:-1], np.cumsum(out[1])[:-1]


def splitters(rows: DataFrame, pieces: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """pieces - 1 keys (a key belongs to the piece above it) and the rows below each of them."""
    total = rows.agg(F.sum("__size")).first()[0] or 0
    goal = total * np.arange(1, pieces) / pieces
    low, high = np.zeros(pieces - 1, np.int64), np.full(pieces - 1, (1 << KEY_BITS) - 1, np.int64)
    best, miss, rows_below = np.zeros(pieces - 1, np.int64), goal.copy(), np.zeros(pieces - 1, np.int64)
    for _ in range(MAX_ROUNDS):
        todo = np.flatnonzero((miss > tolerance * total / pieces) & (high - low > 1))
        if not len(todo) or not total:
            break
        span = (high[todo] - low[todo]).astype(np.float64)
        probes = np.unique(np.concatenate([np.minimum(low[todo] + np.maximum((span * (k / (PROBES + 1))).astype(np.int64), 1), high[todo])
                                           for k in range(1, PROBES + 1)]))
        size, n = _below(rows, probes)
        for i in todo:
            j = int(np.searchsorted(size, goal[i]))
            for k in (j - 1, j):
                if 0 <= k < len(probes) and abs(size[k] - goal[i]) < miss[i]:
                    best[i], miss[i], rows_below[i] = probes[k], abs(size[k] - goal[i]), n[k]
            if j > 0:
                low[i] = max(low[i], probes[j - 1])
            if j < len(probes):
                high[i] = min(high[i], probes[j])
    order = np.argsort(best, kind="stable")
    return best[order], rows_below[order]


def shard(docs: DataFrame, shards: int = SHARDS, parts: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with shard and slot (gapless from 0 in each shard); bytes of the shards are near equal.

    ``parts`` pieces of a shard are ordered by a task each; by default there are as many pieces as shuffle partitions.
    """
    if parts is None:
        parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    # Helper columns live beside one struct of the document, so names can't clash.
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = keyed(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in own]).alias("row")))
    keys, below = splitters(cut_lineage(rows.select("__key", "__size")), shards * parts, tolerance)
    first = np.concatenate([[0], below])
    offset = first - first[(np.arange(shards * parts) // parts) * parts]
    cut = docs.sparkSession.createDataFrame([(i, int(o)) for i, o in enumerate(offset)], "__piece int, __offset bigint")
    known = docs.sparkSession.sparkContext.broadcast(keys)  # shards * parts keys

    @F.pandas_udf("int")
    def piece_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(known.value, key.to_numpy(), side="right").astype(np.int32))

    rows = rows.select("doc_id", "row", "__key", "__tie", piece_of("__key").alias("__piece"))
    rows = rows.join(F.broadcast(cut), "__piece")  # shards * parts rows
    place = F.row_number().over(Window.partitionBy("__piece").orderBy("__key", "doc_id", "__tie")) - 1
    return rows.select(*[F.col("row").getField(c).alias(c) for c in own], F.floor(F.col("__piece") / parts).cast("int").alias("shard"),
                       (F.col("__offset") + place).cast("bigint").alias("slot"))


def report(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = docs.select("doc_id", "text", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard(digest).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
