"""Benchmark decontamination: a broadcast set of normalised benchmark windows against training token windows.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. A window is ``width``
consecutive words of a benchmark item; an item with fewer words (but some) is one window. Every window of
every whole training text is looked up by fingerprint and each hit is verified word by word, so a
fingerprint collision never counts. Words inside an occurrence of any window are hit words.

The benchmark's windows are broadcast only up to ``max_windows`` rows and ``max_bytes`` of them. A larger benchmark
is cut into slices, each counted against both bounds; a row is an (item, window), so the items of one window
may lie in several slices. The training table is scanned once for each slice, and the hit words of the slices
are united by document, so results do not depend on the bounds. Only a single row may exceed ``max_bytes``.

Defined cases: a null or wordless text has no words, no hits and is not contaminated. Benchmark rows with a
null id or without words have no windows; rows that repeat an ``item_id`` are one item. A repeated document
row gives its own result row; a null ``doc_id`` is kept as it is. Further columns are ignored by ``scan``
and kept by ``remove_documents`` / ``remove_spans``.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.textbatch import (ALNUM_WORDS, Rolling, chunks, documents, lower_ascii, row_key, utf8, word_hashes,
                                    word_spans)

WIDTH = 13
MAX_WINDOWS = 1 << 19  # about 100 MB of window text at 13 words each
MAX_BYTES = 128 << 20  # of windows and item ids in one broadcast
SHARE = 20  # contaminated if SHARE * hit words >= words
_FILTER = 1 << 20

_WINDOWS = "item_id string, n_words int, hash bigint, window binary"
_HITS = "doc_id bigint, row_key bigint, n_words bigint, hits array<int>, items array<string>"


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each distinct (item, window): item_id, n_words, hash, window (words joined by a space)."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                data, offsets = utf8(part.column("text"))
                data = lower_ascii(data)
                starts, ends, doc = word_spans(data, offsets, ALNUM_WORDS)
                ids = part.column("item_id").to_pylist()
                hashes = word_hashes(data, starts, ends)
                roll, raw = Rolling(hashes), data.tobytes()
                bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
                out = defaultdict(list)
                for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                    n = min(width, hi - lo)
                    if not n or ids[i] is None:
                        continue
                    at = np.arange(lo, hi - n + 1)
                    for s, h in zip(at, roll.spans(at, at + n).astype(np.int64)):
                        out["item_id"].append(ids[i])
                        out["n_words"].append(int(n))
                        out["hash"].append(int(h))
                        out["window"].append(b" ".join(raw[a:b] for a, b in zip(starts[s:s + n], ends[s:s + n])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.string()), pa.array(out["n_words"], pa.int32()),
                                                      pa.array(out["hash"], pa.int64()), pa.array(out["window"], pa.binary())],
                                                     names=["item_id", "n_words", "hash", "window"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return rows.mapInArrow(run, _WINDOWS).distinct()


class WindowSet:
    """The broadcast form of a slice of windows: sorted fingerprints by window length, and their texts."""

    def __init__(self, rows):
        self.items = defaultdict(set)  # (n_words, window) -> item ids
        by_length = defaultdict(set)
        for r in rows:
            self.items[r["n_words"], bytes(r["window"])].add(r["item_id"])
            by_length[r["n_words"]].add(r["hash"])
        self.sorted = {n: np.sort(np.array(list(h), np.int64).astype(np.uint64)) for n, h in by_length.items()}

    def find(self, data: np.ndarray, offsets: np.ndarray):
        """Words of each document, and verified hits as (document, first word, words, item ids)."""
        data = lower_ascii(data)
        starts, ends, doc = word_spans(data, offsets, ALNUM_WORDS)
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        roll, hits = Rolling(word_hashes(data, starts, ends)), []
        for n, known in self.sorted.items():
            at = np.arange(max(0, len(starts) - n + 1))
            at = at[doc[at] == doc[at + n - 1]] if len(at) else at
            if not len(at):
                continue
            maybe = np.zeros(_FILTER, bool)
            maybe[(known & np.uint64(_FILTER - 1)).astype(np.int64)] = True
            h = roll.spans(at, at + n)
            keep = maybe[(h & np.uint64(_FILTER - 1)).astype(np.int64)]
            at, h = at[keep], h[keep]
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for s in at[known[place] == h]:
                text = b" ".join(data[a:b].tobytes() for a, b in zip(starts[s:s + n], ends[s:s + n]))
                items = self.items.get((n, text))
                if items:
                    hits.append((int(doc[s]), int(s - bounds[doc[s]]), n, items))
        return np.diff(bounds), (starts, ends, bounds), hits


def _slices(benchmark: DataFrame, width: int, max_windows: int, max_bytes: int = MAX_BYTES) -> list[DataFrame]:
    """The rows of ``benchmark_windows`` in slices that are counted: no more than ``max_windows`` rows and ``max_bytes`` each."""
    windows = benchmark_windows(benchmark, width)
    size = F.octet_length("window") + F.octet_length("item_id")
    counts = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")]
    all_ = windows.agg(*counts).first()
    k = max(1, math.ceil(all_["n"] / max_windows), math.ceil(all_["bytes"] / max_bytes))
    if k == 1:
        return [windows]
    while True:
        at = F.pmod(F.xxhash64("item_id", "n_words", "window"), F.lit(k))
        over = (F.col("n") > max_windows) | ((F.col("bytes") > max_bytes) & (F.col("n") > 1))
        if not windows.groupBy(at.alias("slice")).agg(*counts).where(over).take(1):
            return [windows.where(at == i) for i in range(k)]
        k += max(1, k // 8)


def _scan_slice(docs: DataFrame, windows: DataFrame) -> DataFrame:
    known = docs.sparkSession.sparkContext.broadcast(WindowSet(windows.collect()))  # bounded rows and bytes (see _slices)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                n_words, _, hits = known.value.find(*utf8(part.column("text")))
                words, items = defaultdict(set), defaultdict(set)
                for d, s, n, ids in hits:
                    words[d].update(range(s, s + n))
                    items[d] |= ids
                m = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"), pa.array(n_words, pa.int64()),
                     pa.array([sorted(words[i]) if i in words else [] for i in range(m)], pa.list_(pa.int32())),
                     pa.array([sorted(items[i]) if i in items else [] for i in range(m)], pa.list_(pa.string()))],
                    names=["doc_id", "row_key", "n_words", "hits", "items"])

    return documents(docs).withColumn("row_key", row_key()).mapInArrow(run, _HITS)


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = SHARE,
         max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, items (sorted ids), hits (word positions) and contaminated for every row."""
    return _scan(docs, _slices(benchmark, width, max_windows, max_bytes), share)


def _scan(docs: DataFrame, slices: list[DataFrame], share: int) -> DataFrame:
    parts = [_scan_slice(docs, s) for s in slices]
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        # One result for each (doc_id, text); copies of a row take it again, as often as the row stands there.
        one = (out.groupBy("doc_id", "row_key")
               .agg(F.max("n_words").alias("n_words"),
                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
        keys = docs.select("doc_id", row_key().alias("row_key"))
        k = keys.alias("k")
        out = (k.join(one.alias("o"), F.col("k.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("k.row_key") == F.col("o.row_key")))
               .select("k.doc_id", "k.row_key", "o.n_words", "o.hits", "o.items"))
    return out.withColumn("n_hit", F.size("hits").cast("bigint")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Digest columns of ``scan``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return scan(docs, benchmark, **kw).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def _without(text: bytes, starts: np.ndarray, ends: np.ndarray, words) -> str:
    """``text`` without the runs of the given words; starts and ends: of all its words."""
    keep, at, last = [], 0, None
    for k in sorted(words):
        if last is None or last != k - 1:
            keep.append(text[at:starts[k]])
        at, last = ends[k], k
    return b"".join([*keep, text[at:]]).decode()


def _clean(docs: DataFrame, benchmark: DataFrame, width: int, share: int, max_windows: int, max_bytes: int, spans: bool) -> DataFrame:
    slices = _slices(benchmark, width, max_windows, max_bytes)
    if len(slices) > 1:
        return _clean_by_scan(docs, _scan(docs, slices, share), spans)
    known = docs.sparkSession.sparkContext.broadcast(WindowSet(slices[0].collect()))

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                data, offsets = utf8(part.column("text"))
                n_words, (starts, ends, bounds), hits = known.value.find(data, offsets)
                words = defaultdict(set)
                for d, s, n, _ in hits:
                    words[d].update(range(s, s + n))
                if not spans:
                    bad = np.zeros(part.num_rows, bool)
                    for d, w in words.items():
                        bad[d] = share * len(w) >= n_words[d]
                    part = part.filter(pa.array(~bad))
                elif words:
                    texts, raw = part.column("text").to_pylist(), data.tobytes()
                    for d, w in words.items():
                        own = slice(bounds[d], bounds[d + 1])
                        texts[d] = _without(raw[offsets[d]:offsets[d + 1]], starts[own] - offsets[d], ends[own] - offsets[d], w)
                    at = part.schema.get_field_index("text")
                    part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
                if part.num_rows:
                    yield part

    return docs.mapInArrow(run, docs.schema)


def _clean_by_scan(docs: DataFrame, found: DataFrame, spans: bool) -> DataFrame:
    """``_clean`` from the united hits of all slices, joined to the rows by (doc_id, row_key)."""
    d = docs.withColumn("__row_key", row_key()).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.__row_key") == F.col("b.row_key"))
    if not spans:
        bad = found.where("contaminated").select("doc_id", "row_key").distinct().alias("b")
        return d.join(bad, same, "left_anti").select("d.*").drop("__row_key")
    hit = found.where("n_hit > 0").select("doc_id", "row_key", "hits").dropDuplicates(["doc_id", "row_key"]).alias("b")
    rows = d.join(hit, same, "left").select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col("b.hits").alias("__hits"))

    def run(batches):
        for batch in batches:
            hits, part = batch.column("__hits").to_pylist(), batch.drop_columns(["__hits"])
            if any(hits):
                texts = part.column("text").to_pylist()
                for i, words in enumerate(hits):
                    if words:
                        raw = texts[i].encode()
                        data = lower_ascii(np.frombuffer(raw, np.uint8))
                        starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM_WORDS)
                        texts[i] = _without(raw, starts, ends, words)
                at = part.schema.get_field_index("text")
                part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
            yield part

    return rows.mapInArrow(run, docs.schema)


def remove_documents(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = SHARE,
                     max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` without the contaminated documents; all columns stay."""
    return _clean(docs, benchmark, width, share, max_windows, max_bytes, spans=False)


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` with every hit run of words cut out of its text; all columns stay."""
    return _clean(docs, benchmark, width, SHARE, max_windows, max_bytes, spans=True)
