"""Fill-in-middle transformation: the unit boundaries of a text as a compressed set, cut at two selected boundaries.

The end of every unit (a word with the white space before it, or white space at the end of a text) is a position in
code points. A text's positions form a set in the manner of Roaring bitmaps: positions that share their high bits
lie in one container of 2^16 places, an array of places, a bitmap or a list of runs, whichever is smallest, and
containers carry cumulative cardinalities. The k-th boundary is found by a search for its container and a select
within it, so sets that are stored once (``boundary_sets``) can be cut anew for any seed without the texts' units.

Documents are independent of each other: no shuffle, and a task holds one chunk of texts. The cuts, two numbers a
document, come back from Python; texts are cut and put together by built-in functions.

Defined cases: a null text counts as empty and stays whole (form plain). A null doc_id counts as an empty number
in the hash. Repeated rows give repeated results. An empty table gives an empty result. Further columns stay; columns
with the names of results are replaced.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.textbatch import SPACE_WORDS, chunks, utf8, word_spans

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM_RATE = 50, 80  # per cent of texts that are cut, and of these that put the suffix first

ARRAY, BITMAP, RUN = range(3)
PLACES = 1 << 16
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


class BoundarySet:
    """A sorted set of positions. ``select(k)`` is the k-th smallest one, k from 1; ``select(0)`` is 0."""

    def __init__(self, keys, kinds, sizes, parts):
        self.keys, self.kinds, self.parts = keys, kinds, parts
        self.below = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])  # cumulative cardinalities

    @classmethod
    def of(cls, positions: np.ndarray) -> "BoundarySet":
        """From ascending distinct positions."""
        high = positions // PLACES
        cuts = np.flatnonzero(np.diff(high)) + 1
        groups = np.split(positions, cuts) if len(positions) else []
        kinds, parts = zip(*(cls._container(g % PLACES) for g in groups)) if groups else ((), ())
        return cls(high[np.concatenate([[0], cuts])] if groups else high, list(kinds), [len(g) for g in groups], list(parts))

    @staticmethod
    def _container(places: np.ndarray) -> tuple[int, np.ndarray]:
        starts = np.flatnonzero(np.diff(places, prepend=-2) != 1)
        if 4 * len(starts) < min(2 * len(places), PLACES // 8):
            lengths = np.diff(starts, append=len(places))
            return RUN, np.stack([places[starts], lengths - 1]).astype(np.uint16)
        if 2 * len(places) <= PLACES // 8:
            return ARRAY, places.astype(np.uint16)
        bits = np.zeros(PLACES, np.uint8)
        bits[places] = 1
        return BITMAP, np.packbits(bits, bitorder="little").view(np.uint64)

    def __len__(self) -> int:
        return int(self.below[-1])

    def select(self, k: int) -> int:
        if not k:
            return 0
        i = int(np.searchsorted(self.below, k)) - 1  # the container that holds the k-th position
        return int(self.keys[i]) * PLACES + self._place(self.kinds[i], self.parts[i], k - 1 - int(self.below[i]))

    @staticmethod
    def _place(kind: int, part: np.ndarray, k: int) -> int:
        if kind == ARRAY:
            return int(part[k])
        if kind == RUN:
            ends = np.cumsum(part[1], dtype=np.int64) + np.arange(1, part.shape[1] + 1)
            r = int(np.searchsorted(ends, k, side="right"))
            return int(part[0, r]) + k - (int(ends[r - 1]) if r else 0)
        ends = np.cumsum(np.bitwise_count(part), dtype=np.int64)
        w = int(np.searchsorted(ends, k, side="right"))
        ones = np.flatnonzero(np.unpackbits(part[w:w + 1].view(np.uint8), bitorder="little"))
        return 64 * w + int(ones[k - (int(ends[w - 1]) if w else 0)])

    def to_bytes(self) -> bytes:
        head = [struct.pack("<I", len(self.parts))]
        for key, kind, size, part in zip(self.keys, self.kinds, np.diff(self.below), self.parts):
            head.append(struct.pack("<QBII", int(key), kind, int(size), part.size))
        return b"".join(head + [p.tobytes() for p in self.parts])

    @classmethod
    def from_bytes(cls, data: bytes) -> "BoundarySet":
        (count,) = struct.unpack_from("<I", data)
        step = struct.calcsize("<QBII")
        heads = [struct.unpack_from("<QBII", data, 4 + step * i) for i in range(count)]
        at, parts = 4 + step * count, []
        for _, kind, _, length in heads:
            part = np.frombuffer(data, np.uint64 if kind == BITMAP else np.uint16, length, at)
            parts.append(part.reshape(2, -1) if kind == RUN else part)
            at += part.nbytes
        return cls(np.array([h[0] for h in heads], np.int64), [h[1] for h in heads], [h[2] for h in heads], parts)


def _text_positions(text: pa.Array, characters: bool):
    """For each text of one chunk, the ends of its units in code points."""
    data, offsets = utf8(text)
    points = np.zeros(len(data) + 1, np.int32)  # code points before each byte; a batch's texts are below 2 GB
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    if characters:
        yield from (np.arange(1, points[b] - points[a] + 1) for a, b in zip(offsets[:-1], offsets[1:]))
        return
    _, ends, doc = word_spans(data, offsets, SPACE_WORDS)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    for d in range(len(offsets) - 1):
        own, last = ends[bounds[d]:bounds[d + 1]], offsets[d + 1]
        if last > offsets[d] and not (len(own) and own[-1] == last):
            own = np.append(own, last)  # white space at the end
        yield (points[own] - points[offsets[d]]).astype(np.int64)


def boundary_sets(text: Column, units: str = "words") -> Column:
    """The boundary set of each text, as binary; ``units`` is "words" or "characters"."""
    if units not in ("words", "characters"):
        raise ValueError(f"units: {units}")

    @F.arrow_udf("binary")
    def build(t: pa.Array) -> pa.Array:
        out = [BoundarySet.of(p).to_bytes() for c in chunks(pa.RecordBatch.from_arrays([t], ["text"]))
               for p in _text_positions(c.column("text"), units == "characters")]
        return pa.array(out, pa.binary())

    return build(text)


def cuts(sets: Column, first: Column, second: Column) -> Column:
    """n (units) and, after first % (n + 1) and second % (n + 1) units, the smaller and the larger cut in code points."""

    @F.arrow_udf("n bigint, a bigint, b bigint")
    def cut(s: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        out = np.zeros((3, len(s)), np.int64)
        for i, (data, x, y) in enumerate(zip(s, h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False))):
            known = BoundarySet.from_bytes(data.as_py())
            n = len(known)
            x, y = sorted((int(x) % (n + 1), int(y) % (n + 1)))
            out[:, i] = n, known.select(x), known.select(y)
        return pa.StructArray.from_arrays([pa.array(c) for c in out], names=["n", "a", "b"])

    return cut(sets, first, second)


def _hashes(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of sha256 of seed:doc_id, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(docs: DataFrame, seed: int = 42, rate: int = RATE, spm_rate: int = SPM_RATE, units: str = "words") -> DataFrame:
    """``docs`` with n, form (plain, psm or spm), prefix_chars, middle_chars and output."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2, h3, h4 = _hashes(F.col("doc_id"), seed)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS]
    cut = "cut"
    while cut in docs.columns:
        cut += "_"
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    rows = docs.select(*own, form.alias("form"), cuts(boundary_sets(text, units), h1, h2).alias(cut))
    a, b, plain = F.col(f"{cut}.a"), F.col(f"{cut}.b"), F.col("form") == "plain"
    length = F.length(text)
    piece = lambda start, end: F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))
    prefix, middle, suffix = piece(F.lit(0), a), piece(a, b), piece(b, length)
    output = (F.when(plain, text).when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    return rows.select(*own, F.col(f"{cut}.n").alias("n"), "form", F.when(~plain, a).alias("prefix_chars"),
                       F.when(~plain, b - a).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that ``transform`` made ``output`` from. Marks are unambiguous: no cut text holds one, and none overlaps itself."""
    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        """What lies before ``first`` (without the mark at the start), between the two marks, and after ``second``."""
        i = F.instr(output, first)
        j = F.locate(second, F.substring(output, i, F.length(output))) + i - 1
        return F.substring(output, F.lit(4), i - 4), F.substring(output, i + 3, j - i - 3), F.substring(output, j + 3, F.length(output))

    prefix, suffix, middle = between(SUFFIX, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = between(PREFIX, MIDDLE)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def report(docs: DataFrame) -> DataFrame:
    done = transform(docs.select("doc_id", "text"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
