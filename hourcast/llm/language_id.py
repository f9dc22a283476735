"""Language identification with language-bitmask n-gram filters.

Training counts letter n-grams of every labelled text by language; an n-gram belongs to each language in which
it has at least ``min_share`` of the n-grams. All (n-gram, language) pairs go into one bit-sliced Bloom filter:
cell c holds a bit for every language, an n-gram sets its language's bit in ``HASHES`` cells, and one lookup -
the AND of those cells - returns all languages that contain the n-gram. A text gets a popcount for each
language; the share that false positives would give (the slice's fill to the power ``HASHES``) is taken out,
and the largest corrected share decides.

The filter has ``CELLS`` cells of ceil(languages / 63) words, whatever the corpus, so it can be broadcast.

Defined cases: a null text or one without letters is ``und`` with score 0. Rows with a null ``lang`` teach
nothing. A null ``doc_id`` counts as the empty text in the fold rule. Ties go to the language that sorts first;
a text none of whose n-grams is known gets the language with most training n-grams and score 0. Without any
training rows every text is ``und``. Repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.textbatch import chunks, mix

GRAMS = (3, 4)  # letters of an n-gram; a word's edge counts as a letter
CELLS = 1 << 20
HASHES = 3
MIN_SHARE = 1e-5  # of a language's n-grams
WORD_BITS = 63
_FLUSH = 1 << 22

UNKNOWN = "und"


def fold(modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


def ngrams(texts: list[str | None], grams: tuple[int, ...] = GRAMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit n-grams of lower-cased words, their documents, and which documents have letters."""
    low = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum([1] + [len(t) + 1 for t in low])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one edge after every run of letters
    keep[0] = True
    place = np.flatnonzero(keep)
    seq = np.where(letter, codes, 0)[place].astype(np.uint64)
    doc = np.searchsorted(begins, place, side="right") - 1
    has = np.zeros(len(low) + 1, bool)
    has[doc[seq > 0]] = True
    out, at = [], []
    for n in grams:
        if len(seq) < n:
            continue
        m = len(seq) - n + 1
        inner = np.ones(m, bool)
        for j in range(1, n - 1):
            inner &= seq[j:j + m] > 0
        code = np.full(m, n, np.uint64)
        for j in range(n):
            code = code * np.uint64(0x200003) + seq[j:j + m]
        ok = np.flatnonzero(inner)
        out.append(mix(code[ok]))
        at.append(doc[ok + 1])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has[:-1]
    return np.concatenate(out), np.concatenate(at), has[:-1]


def _cells(gram: np.ndarray, cells: int, hashes: int) -> list[np.ndarray]:
    a, b = gram >> np.uint64(32), (gram & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return [((a + np.uint64(i) * b) % np.uint64(cells)).astype(np.int64) for i in range(hashes)]


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang)."""

    def run(batches):
        held: dict[str, list[np.ndarray]] = {}
        n = 0

        def flush():
            for lang, parts in held.items():
                gram, count = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)),
                                                  pa.array(count.astype(np.int64))], names=["lang", "gram", "n"])

        for batch in batches:
            for part in chunks(batch):
                gram, doc, _ = ngrams(part.column("text").to_pylist())
                langs = np.array(part.column("lang").to_pylist(), object)[doc]
                for lang in set(langs):
                    held.setdefault(lang, []).append(gram[langs == lang])
                n += len(gram)
                if n >= _FLUSH:
                    yield from flush()
                    held, n = {}, 0
        yield from flush()

    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filter:
    """The fitted bit-sliced filter."""

    def __init__(self, langs: list[str], table: np.ndarray, hashes: int, usual: int):
        self.langs, self.table, self.hashes, self.usual = langs, table, hashes, usual
        fill = np.array([(table[:, i // WORD_BITS] >> (i % WORD_BITS) & 1).mean() for i in range(len(langs))])
        self.false = fill ** hashes

    def shares(self, gram: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Corrected share of each document's n-grams in each language."""
        at = _cells(gram, len(self.table), self.hashes)
        total = np.bincount(doc, minlength=n)
        out = np.zeros((n, len(self.langs)))
        for w in range(self.table.shape[1]):
            mask = self.table[at[0], w]
            for a in at[1:]:
                mask = mask & self.table[a, w]
            for i in range(w * WORD_BITS, min(len(self.langs), (w + 1) * WORD_BITS)):
                out[:, i] = np.bincount(doc[(mask >> (i - w * WORD_BITS) & 1).astype(bool)], minlength=n)
        out = (out / np.maximum(total, 1)[:, None] - self.false) / (1 - self.false)
        return np.maximum(out, 0)


def fit(labelled: DataFrame, cells: int = CELLS, hashes: int = HASHES, min_share: float = MIN_SHARE) -> Filter:
    """Filter of all rows of (text, lang); only languages, totals and the filter's cells reach the driver."""
    counts = gram_counts(labelled).persist()
    totals = sorted((r["lang"], r["n"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    langs = [k for k, _ in totals]
    words = max(1, -(-len(langs) // WORD_BITS))
    table = np.zeros((cells, words), np.int64)
    if langs:
        known = counts.sparkSession.createDataFrame([(k, i, float(n)) for i, (k, n) in enumerate(totals)], "lang string, i int, total double")
        inside = counts.join(F.broadcast(known), "lang").where(F.col("n") >= F.col("total") * min_share).select("gram", "i")

        def place(batches):
            for b in batches:
                gram, i = b.column("gram").to_numpy().astype(np.uint64), b.column("i").to_numpy()
                for c in _cells(gram, cells, hashes):
                    yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(i // WORD_BITS), pa.array(np.int64(1) << (i % WORD_BITS).astype(np.int64))],
                                                     names=["cell", "word", "mask"])

        # At most cells * words rows, whatever the corpus.
        got = inside.mapInArrow(place, "cell bigint, word int, mask bigint").groupBy("cell", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
        table[got.column("cell").to_numpy(), got.column("word").to_numpy()] = got.column("mask").to_numpy()
    counts.unpersist()
    return Filter(langs, table, hashes, int(np.argmax([n for _, n in totals])) if totals else 0)


def predict(docs: DataFrame, model: Filter, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, lang_pred and score (the winner's part of all corrected shares) for every row; reads only ``text``."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # CELLS * 8 bytes for each 63 languages
    rows = docs.select("doc_id", *keep, "text")

    def run(batches):
        f = known.value
        for batch in batches:
            for part in chunks(batch):
                gram, doc, has = ngrams(part.column("text").to_pylist())
                n = part.num_rows
                pred, score = np.full(n, UNKNOWN, object), np.zeros(n)
                if f.langs:
                    share = f.shares(gram, doc, n)
                    best, whole = share.argmax(axis=1), share.sum(axis=1)
                    best = np.where(whole > 0, best, f.usual)
                    pred = np.where(has, np.array(f.langs, object)[best], UNKNOWN)
                    score = np.where(has & (whole > 0), share[np.arange(n), best] / np.where(whole > 0, whole, 1), 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(pred.tolist(), pa.string()), pa.array(score)],
                                                 names=[*part.schema.names[:-1], "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, schema + ", lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    """Learns from the folds other than 2 of 4 and predicts every row."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", fold(4) == 2)
    model = fit(rows.where("not held_out"))
    return predict(rows, model, keep=("held_out",))
