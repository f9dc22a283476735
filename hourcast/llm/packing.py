"""Harmonic packing: token pieces in reciprocal-capacity classes, a fixed number of pieces to a sequence.

A document is its token ids and an end id. It is cut into full sequences and a rest. A length in
(C / (k + 1), C / k] belongs to class k, whose sequences hold k pieces each, so a sequence is filled by counting
and classes are filled independently of each other on all workers. A rest that would waste more than ``SLACK``
of its place is first cut at the next class's full length, so that most places are almost full.

Pieces of a class are numbered across all partitions (counts by partition and class, prefix sums, then a number
within each), so a class leaves at most one open sequence, not one for each worker. These open ends - fewer than
k pieces for each class, a bound that only C sets - are packed together by decreasing length.

Tokens are made once for each distinct word of a task: the tokenizer's normalizer and splitter never look across
white space, so a text's ids are its words' ids in a row.

Defined cases: a null or empty text is the end id alone. Repeated rows and null ids are documents of their own,
which (doc_id, start) alone does not tell apart; ``sequence_id`` and ``offset`` do. An empty table gives an
empty result. Further columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections import defaultdict
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.textbatch import SPACE_WORDS, Rolling, chunks, lower_ascii, utf8
from hourcast.session_paths import scratch

CAPACITY = 4096
END_ID = 2
SLACK = 0.04  # part of a place that may stay empty
MAX_CACHE = 3 << 18  # words a worker remembers, 16 bytes and their ids each
CHUNK = 1 << 20  # bytes of text that are encoded at once
PART_BYTES = 32 << 20  # of ids in a partition when they move to their places
SPREAD = 64  # numbers of a class are given out in as many groups for each shuffle partition


class WordTokenizer:
    """Ids of whole texts, made word by word and remembered.

    A word is a run without ASCII white space; a full stop or comma between ASCII letters or digits and the end
    of such a run, or further letters or digits, is a word of its own. A-Z are lower-cased first (as the
    tokenizer does) in words of ASCII without ``<``. Words are remembered by 64-bit fingerprint.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a run of letters
        if suffix:
            self.closing[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.keys, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word in a row, and how many each has."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.array([len(g) for g in got], np.int64)
        return np.array(list(chain.from_iterable(got)), np.uint32), size

    def _letter_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of a-z: many are encoded as one text, in which every word ends with a closing id."""
        ids, _ = self._ids([" ".join(words[i:i + _JOINED]) for i in range(0, len(words), _JOINED)])
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._ids(words)
        return ids, np.diff(ends, prepend=0)

    def _learn(self, keys: np.ndarray, words: list[str], letters: np.ndarray) -> None:
        size, first = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for which, ids_of in ((np.flatnonzero(letters), self._letter_ids), (np.flatnonzero(~letters), self._ids)):
            if not len(which):
                continue
            ids, n = ids_of([words[i] for i in which])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
            self.ids[self.used:self.used + len(ids)] = ids
            size[which], first[which] = n, self.used + np.cumsum(n) - n
            self.used += len(ids)
        at = np.searchsorted(self.keys, keys)  # both are sorted
        self.keys, self.first, self.size = np.insert(self.keys, at, keys), np.insert(self.first, at, first), np.insert(self.size, at, size)

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text's."""
        data, offsets = utf8(col)
        starts, ends, doc = _words(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        kept = np.concatenate([[0], np.cumsum((data >= 128) | (data == 0x3C))])
        raw = kept[ends] > kept[starts]
        shown = lower_ascii(data)
        upper = np.flatnonzero(shown != data)
        upper = upper[raw[np.searchsorted(starts, upper, side="right") - 1]]
        shown[upper] = data[upper]
        keys, where, word = np.unique(Rolling.of_bytes(shown).spans(starts, ends), return_index=True, return_inverse=True)
        if len(keys) + len(self.keys) > MAX_CACHE:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            s, e = starts[where[new]], ends[where[new]]
            other = np.concatenate([[0], np.cumsum((shown < 0x61) | (shown > 0x7A))])
            text = shown.tobytes()
            self._learn(keys[new], [text[i:j].decode() for i, j in zip(s.tolist(), e.tolist())], other[e] == other[s])
            at = np.searchsorted(self.keys, keys)
        first, size = self.first[at][word].astype(np.int64), self.size[at][word].astype(np.int64)
        shift = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(first - shift[:-1], size) + np.arange(shift[-1])]
        return ids, shift[np.searchsorted(doc, np.arange(len(offsets)))]


@cache
def _tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker: later tasks of the worker know its words already."""
    return WordTokenizer(path)


_JOINED = 64


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside, alnum = SPACE_WORDS[data], _ALNUM[data]
    edge = np.zeros(len(data) + 1, bool)  # a document begins here, or the data end
    edge[offsets] = True
    own = (data == 0x2E) | (data == 0x2C)
    own[1:] &= alnum[:-1] & ~edge[1:-1]
    own[0] = False
    after = edge[1:].copy()
    after[:-1] |= ~inside[1:] | alnum[1:]
    own &= after
    first, last = inside & (own | edge[:-1]), inside & (own | edge[1:])
    first[1:] |= inside[1:] & (~inside[:-1] | own[:-1])
    last[:-1] |= inside[:-1] & (~inside[1:] | own[1:])
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = True


def cuts(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        place = capacity // (capacity // rest)
        if place - rest <= slack * place:
            out.append(rest)
            break
        full = capacity // (capacity // rest + 1)  # the longest full place that fits
        out.append(full)
        rest -= full
    return out


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK, ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, k (class), part (task), piece (number within the task), and ``ids`` if asked for."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k", "part", "piece"] + (["ids"] if ids else [])

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tokenizer, made = None, 0
        for batch in batches:
            for b in chunks(batch, limit=CHUNK):
                tokenizer = tokenizer or _tokenizer(path)
                out = defaultdict(list)
                flat, bounds = tokenizer.encode(b.column("text"))
                for doc, lo, hi in zip(b.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    got = np.append(flat[lo:hi], np.uint32(end_id)).astype("<u4")
                    at = 0
                    for n in cuts(len(got), capacity, slack):
                        piece = got[at:at + n]
                        for k, v in zip(names, (doc, at, n, zlib.crc32(piece.tobytes()), len(got), capacity // n, part, made, piece)):
                            out[k].append(v)
                        at, made = at + n, made + 1
                types = {"k": pa.int32(), "part": pa.int32(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays([pa.array(out[n], types.get(n, pa.int64())) for n in names], names=names)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, k int, part int, piece bigint" + (", ids array<int>" if ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _ends(rows: list[tuple], capacity: int) -> list[tuple]:
    """(piece number, bin, offset) by decreasing length into the fullest bin that has room."""
    room = defaultdict(list)  # space left -> bins
    spaces = np.zeros(capacity + 1, np.int64)
    out, n = [], 0
    for length, number in sorted(rows, key=lambda r: (-r[0], r[1])):
        fit = np.flatnonzero(spaces[length:])
        if len(fit):
            left = int(fit[0]) + length
            b = room[left].pop()
            spaces[left] -= 1
        else:
            b, left, n = n, capacity, n + 1
        out.append((number, b, capacity - left))
        room[left - length].append(b)
        spaces[left - length] += 1
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK, ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset; every id of every document lies in exactly one piece.

    Tokens are made once and written to the shared scratch folder. Numbers and places come from the pieces' lengths
    alone; ``ids`` are read again and moved once, in partitions of about ``PART_BYTES``, to the places found.
    """
    spark = docs.sparkSession
    stored = scratch(spark, "pieces", uuid.uuid4().hex)
    pieces(docs, path, capacity, end_id, slack, ids).write.parquet(stored)
    stored = spark.read.parquet(stored)
    placed = _place(stored.drop("ids"), capacity)
    if not ids:
        return placed.drop("part", "piece")
    size = 4 * (stored.agg(F.sum("length")).first()[0] or 0)
    n, key = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES)), ["part", "piece"]
    return placed.repartition(n, *key).join(stored.select(*key, "ids").repartition(n, *key), key).drop(*key)


def _place(rows: DataFrame, capacity: int) -> DataFrame:
    """Pieces without ids, with sequence_id and offset; (part, piece) names a piece."""
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SPREAD)).cast("int")
    rows = rows.withColumn("grp", F.when(F.col("k") > 1, group).otherwise(F.lit(0))).withColumn("grp", F.col("part") * SPREAD + F.col("grp"))
    # Numbers within a class: rows before the group, and the place in the group.
    counts = rows.groupBy("k", "grp").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy("k", F.floor(F.col("grp") / 4096).alias("span")).agg(F.sum("n").alias("n"))
    before = Window.partitionBy("k").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("k", "span", "before")
    inner = Window.partitionBy("k", "span").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.withColumn("span", F.floor(F.col("grp") / 4096)).withColumn("own", F.coalesce(F.sum("n").over(inner), F.lit(0)))
              .join(spans, ["k", "span"]).select("k", "grp", (F.col("before") + F.col("own")).alias("base")))
    place = F.row_number().over(Window.partitionBy("k", "grp").orderBy("doc_id", "start", "ids_crc32", "part", "piece")) - 1
    rows = rows.withColumn("place", place).join(counts, ["k", "grp"]).withColumn("number", F.col("base") + F.col("place")).drop("place", "base", "grp")

    # Classes in order: whole sequences first, then the open ends of all classes together.
    totals = sorted((r["k"], r["n"]) for r in counts_by_class(rows))
    first, base = {}, 0
    for k, n in totals:
        first[k] = base
        base += n // k
    classes = rows.sparkSession.createDataFrame([(k, first[k], (n // k) * k) for k, n in totals], "k int, first bigint, whole bigint")
    rows = rows.join(F.broadcast(classes), "k")  # at most one row for each class
    tail = rows.where(F.col("number") >= F.col("whole")).select("k", "number", "length").collect()  # fewer than k for each class
    ends = _ends([(r["length"], (r["k"], r["number"])) for r in tail], capacity)
    end = rows.sparkSession.createDataFrame([(k, n, base + b, o) for (k, n), b, o in ends], "k int, number bigint, end_sequence bigint, end_offset int")
    rows = rows.join(F.broadcast(end), ["k", "number"], "left")
    in_bin = Window.partitionBy("sequence_id").orderBy("slot")
    rows = rows.withColumn("sequence_id", F.coalesce("end_sequence", F.col("first") + F.floor(F.col("number") / F.col("k"))))
    rows = rows.withColumn("slot", F.coalesce(F.col("end_offset").cast("bigint"), F.pmod("number", F.col("k"))))
    start = F.coalesce(F.sum("length").over(in_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("offset", start.cast("bigint")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("sequence_id").cast("bigint").alias("sequence_id"), "offset", "part", "piece")


def counts_by_class(rows: DataFrame) -> list:
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()


def fill(packed: DataFrame, capacity: int = CAPACITY) -> float:
    """Share of the sequences' places that hold an id."""
    r = packed.agg(F.sum("length").alias("ids"), F.countDistinct("sequence_id").alias("n")).first()
    return r["ids"] / (r["n"] * capacity) if r["n"] else 1.0


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def report(docs: DataFrame) -> DataFrame:
    return pack(docs, tokenizer_path())
