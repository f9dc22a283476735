"""Toxicity: a hashed linear classifier with counterfactual regularisation.

Features are hashed words and word beginnings, as rates per 100 words. A bounded, documented sample of labelled
rows is fitted by logistic regression with two penalties: the usual squared weights, and the squared change of
the score when an identity term of a labelled sentence is swapped for another term of its kind. Mentions of a
group then weigh alike whichever group is named, so neutral mentions don't take on the tone of the sentences
in which a group happens to appear.

Feature selection counts the whole sample in Spark (document frequencies by label) and takes every feature whose
frequencies differ by ``MIN_Z`` deviations; the driver gets their ids (fewer than ``DIM``) and the sample's values of
them, and fits them sparsely. The weights (``DIM`` floats) are broadcast.

Defined cases: null, empty and wordless texts have no features and get the intercept's score. Rows without a
label, or labelled twice with different labels, teach nothing; an id that stands for several texts teaches one of them. Without any labelled row the score is 0.
Repeated rows are scored alike; further columns are ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.language_id import fold
from hourcast.llm.textbatch import Rolling, chunks, mix, utf8, word_spans, word_table

DIM = 1 << 20
SAMPLE = 20_000  # labelled training rows that are fitted, by hash of the id; all where there are fewer
MIN_Z = 3.5  # of the difference of document frequencies between the labels
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
SMOOTH = 30  # words added to a text's length
L2 = 1e-3
SWAP = 10.0  # weight of the counterfactual penalty
STEPS = 400
THRESHOLD = 0.7

# Identity terms by kind; a term is only swapped within its kind.
IDENTITY = {
    "religion": ("atheist", "buddhist", "catholic", "christian", "hindu", "jewish", "muslim", "protestant", "sikh"),
    "origin": ("african", "american", "arab", "asian", "chinese", "european", "french", "german", "indian", "japanese",
               "latino", "mexican", "polish", "russian", "spanish", "turkish"),
    "skin": ("black", "brown", "white"),
    "gender": ("female", "male", "nonbinary", "transgender"),
    "gender_plural": ("boys", "girls", "men", "women"),
    "orientation": ("bisexual", "gay", "heterosexual", "homosexual", "lesbian", "queer", "straight"),
    "ability": ("able", "autistic", "blind", "deaf", "disabled"),
    "age": ("elderly", "old", "teenage", "young"),
}

# Words: letters a-z (texts are lower-cased first) and everything beyond ASCII.
_WORDS = word_table([*range(0x61), *range(0x7B, 0x80)])


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids and documents of all words and word beginnings, and the number of words of each document."""
    data, offsets = utf8(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    starts, ends, doc = word_spans(data, offsets, _WORDS)
    roll = Rolling.of_bytes(data)
    ids, at = [mix(roll.spans(starts, ends) + np.uint64(1))], [doc]
    for k in BEGINNINGS:
        longer = ends - starts > k
        ids.append(roll.spans(starts[longer], starts[longer] + k))
        at.append(doc[longer])
    return (np.concatenate(ids) % np.uint64(DIM)).astype(np.int64), np.concatenate(at), np.bincount(doc, minlength=len(texts))


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIM, np.float32))
    intercept: float = 0.0
    fitted: bool = False

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(texts))
        ids, doc, n = features(texts)
        z = np.bincount(doc, weights=self.weights[ids], minlength=len(texts)) * 100 / (n + SMOOTH) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, y and text of ``limit`` labelled rows of ``docs``, one for each id (of several texts the least)."""
    one = (labels.select("doc_id", F.col(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
           .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top"))
    there = docs.select("doc_id").join(one, "doc_id").groupBy("doc_id").agg(F.min("y").alias("y"))
    chosen = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most ``limit`` rows
    return rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text"))


def _document_frequencies(sample: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                ids, doc, _ = features(part.column("text").to_pylist())
                y = np.array(part.column("y").to_pylist(), np.int64)
                one = np.unique(doc * DIM + ids)
                key, n = np.unique((one % DIM) * 2 + y[one // DIM], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key >> 1), pa.array(key & 1), pa.array(n.astype(np.int64))], names=["id", "y", "n"])

    rows = sample.mapInArrow(run, "id bigint, y bigint, n bigint")
    return rows.groupBy("id").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
                                  F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))


def _values(sample: DataFrame, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and rate of the sample's selected features, and its labels."""
    known = sample.sparkSession.sparkContext.broadcast(ids)  # fewer than DIM

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                got, doc, n = features(part.column("text").to_pylist())
                place = np.minimum(np.searchsorted(known.value, got), len(known.value) - 1)
                ok = known.value[place] == got
                key, count = np.unique(doc[ok] * len(known.value) + place[ok], return_counts=True)
                cut = np.searchsorted(key // len(known.value), np.arange(part.num_rows + 1))
                cols = (key % len(known.value)).astype(np.int32)
                rate = (count * 100 / (n[key // len(known.value)] + SMOOTH)).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), pa.array([cols[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])], pa.list_(pa.int32())),
                     pa.array([rate[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])], pa.list_(pa.float32()))], names=["y", "cols", "rates"])

    t = sample.mapInArrow(run, "y int, cols array<int>, rates array<float>").toArrow()
    cols = t.column("cols").combine_chunks()
    row = np.repeat(np.arange(t.num_rows), np.diff(cols.offsets.to_numpy())) if t.num_rows else np.zeros(0, np.int64)
    return row, cols.flatten().to_numpy(), t.column("rates").combine_chunks().flatten().to_numpy().astype(float), t.column("y").to_numpy().astype(float)


def _terms() -> list[tuple[str, str, np.ndarray]]:
    return [(kind, t, np.unique(features([t])[0])) for kind, terms in IDENTITY.items() for t in terms]


def _descend(row, col, val, y, n_cols, swaps, l2, swap, steps) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on standardised columns. swaps: (count, columns out, columns in)."""
    n = max(len(y), 1)
    spread = np.sqrt(np.bincount(col, weights=val ** 2, minlength=n_cols) / n) + 1e-3
    val = val / spread[col]
    rate = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    w, b = np.zeros(n_cols), float(np.log(rate / (1 - rate)))
    m, v, mb, vb = np.zeros(n_cols), np.zeros(n_cols), 0.0, 0.0
    total = max(sum(c for c, _, _ in swaps), 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=val * w[col], minlength=len(y)) + b
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g = np.bincount(col, weights=val * r[row], minlength=n_cols) + l2 * w
        for c, out, into in swaps:  # the score's change when the term is swapped, at one mention in 100 words
            change = (w[into] / spread[into]).sum() - (w[out] / spread[out]).sum()
            g[into] += swap * c / total * change / spread[into]
            g[out] -= swap * c / total * change / spread[out]
        gb = r.sum()
        step = 0.1 * min(1, 2 * (1 - t / (steps + 1)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        b -= step * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    return w / spread, b


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, min_z: float = MIN_Z,
         l2: float = L2, swap: float = SWAP, steps: int = STEPS) -> Model:
    rows = _sample(docs, labels, label, sample).persist()
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = counts.get(1, 0), counts.get(0, 0)
    if not pos + neg:
        rows.unpersist()
        return Model()
    a, b = F.col("a") / max(pos, 1), F.col("b") / max(neg, 1)
    p = (F.col("a") + F.col("b")) / (pos + neg)
    z = (a - b) / F.sqrt(p * (1 - p) * (1 / max(pos, 1) + 1 / max(neg, 1)) + 1e-9)
    top = _document_frequencies(rows).where(F.col("a") + F.col("b") >= 3).where(F.abs(z) >= min_z).select("id").collect()
    terms = _terms()
    ids = np.unique(np.concatenate([np.array([r["id"] for r in top], np.int64), *[t for _, _, t in terms]]))
    row, col, val, y = _values(rows, ids)
    rows.unpersist()
    column = {t: np.searchsorted(ids, f) for _, t, f in terms}
    word = {t: np.searchsorted(ids, features([t])[0][0]) for _, t, _ in terms}
    kinds = {}
    for kind, t, _ in terms:
        kinds.setdefault(kind, []).append(t)
    swaps = [(int((col == word[t]).sum()), column[t], column[o]) for ts in kinds.values() for t in ts for o in ts if o != t]
    w, b0 = _descend(row, col, val, y, len(ids), [s for s in swaps if s[0]], l2, swap, steps)
    model = Model(intercept=b0, fitted=True)
    model.weights[ids] = w
    return model


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep`` and score for every row; reads only ``text``."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # DIM floats
    rows = docs.select("doc_id", *keep, "text")

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                s = known.value.scores(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(s)], names=[*part.schema.names[:-1], "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, schema + ", score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                s = known.value.scores(part.column("text").to_pylist())
                part = part.filter(pa.array(s < threshold))
                if part.num_rows:
                    yield part

    return docs.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows whose crc32(doc_id as text) mod 3 is not 1."""
    return docs.where(fold(3) != 1)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(training_rows(docs), labels)
    return score(docs.withColumn("held_out", fold(3) == 1), model, keep=("held_out",)).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
