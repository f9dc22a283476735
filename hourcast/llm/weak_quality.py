"""Quality classifier from weak labels: expectation-maximisation over heuristic labellers, then a hashed linear scorer.

Overlapping labellers each vote good (1), bad (0) or abstain (2) on every whole text, as column expressions over
the measurements of the rule ledger. Texts are then counted by vote pattern - at most 3^labellers counts, over
all documents - and EM estimates from these counts each labeller's behaviour on good and bad texts and the
share of good texts. The pattern's posterior is the weak label. A logistic scorer over hashed word shapes is
fitted to the posteriors of a bounded sample (``SAMPLE`` texts by hash, a documented bound) and scores every text.

Defined cases: null, empty and wordless texts abstain where there is nothing to judge, have only the length
feature, and are scored like any other. Repeated rows are scored alike. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.quality_rules import ledger
from hourcast.llm.textbatch import SPACE_WORDS, by_document, chunks, mix, row_key, utf8, word_hashes, word_spans
from hourcast.session import cut_lineage

DIM = 1 << 14
SAMPLE = 8_000
EM_STEPS = 200
STEPS = 300
L2 = 1e-4
THRESHOLD = 0.5
ABSTAIN = 2

# Labellers: name, when it votes bad, when it votes good (SQL over the measurements); else it abstains.
LABELLERS = (
    ("length", "n_words < 30", "n_words >= 80"),
    ("repetition", "n_words > 0 and n_repeat_words > 0.25 * n_words", "n_words > 0 and n_repeat_words < 0.05 * n_words"),
    ("lines", "n_lines > 1 and n_dup_lines > 0.2 * n_lines", "n_lines > 1 and n_dup_lines = 0"),
    ("symbols", "n_words > 0 and n_symbols > 0.05 * n_words", "n_words > 0 and n_symbols = 0"),
    ("word_length", "n_words > 0 and (word_chars < 3 * n_words or word_chars > 11 * n_words)",
     "n_words > 0 and word_chars between 4 * n_words and 8 * n_words"),
    ("sentences", "n_words >= 30 and n_stops < 0.01 * n_words", "n_words > 0 and n_stops >= 0.03 * n_words"),
    ("letters", "word_chars > 0 and n_letters < 0.8 * word_chars", "word_chars > 0 and n_letters >= 0.9 * word_chars"),
)


def votes(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, and the votes as one number in base 3 (first labeller lowest)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    extra = docs.select("doc_id", "text", row_key().alias("row_key"),
                        (F.length(text) - F.length(F.translate(text, ".!?", ""))).alias("n_stops"),
                        F.length(F.regexp_replace(text, "[^\\p{L}]+", "")).alias("n_letters"))
    book = ledger(extra, keep=("row_key", "n_stops", "n_letters"))
    pattern: Column = F.lit(0)
    for i, (_, bad, good) in enumerate(LABELLERS):
        pattern = pattern + F.when(F.expr(bad), 0).when(F.expr(good), 1).otherwise(ABSTAIN) * (3 ** i)
    return book.select("doc_id", "row_key", pattern.cast("int").alias("pattern"))


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """EM for labellers that are independent given the class.

    Returns the posterior of good for each pattern, P(vote | class) as [labeller, class, vote], and the share of good.
    """
    n = len(LABELLERS)
    vote = np.stack([patterns // 3 ** i % 3 for i in range(n)], axis=1)
    table = np.tile(np.array([[0.5, 0.2, 0.3], [0.2, 0.5, 0.3]]), (n, 1, 1))
    good = 0.7
    post = np.full(len(patterns), good)
    total = max(counts.sum(), 1)
    for _ in range(steps):
        log = np.log([1 - good, good]) + sum(np.log(table[j][:, vote[:, j]]).T for j in range(n))
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        post = p[:, 1] / p.sum(axis=1)
        good = min(max(float((post * counts).sum() / total), 0.02), 0.98)
        for c, weight in enumerate((counts * (1 - post), counts * post)):
            for j in range(n):
                table[j, c] = (np.bincount(vote[:, j], weights=weight, minlength=3) + 1) / (weight.sum() + 3)
    return post, table, good


def shapes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of each text: document, feature, value. Shapes of words and of neighbours, repeats, and length."""
    data, offsets = utf8(part.column("text"))
    starts, ends, doc = word_spans(data, offsets, SPACE_WORDS)
    n = np.bincount(doc, minlength=part.num_rows)
    size = np.concatenate([[0], np.floor(2 * np.log2(np.arange(1, int(n.max(initial=0)) + 1)))]).astype(np.uint64)
    docs = [np.arange(part.num_rows)]
    ids = [mix(size[n] + np.uint64(7 << 40)) % np.uint64(DIM)]
    values = [np.ones(part.num_rows)]
    if len(starts):
        first, last = data[starts], data[ends - 1]
        kind = np.zeros(256, np.uint64)
        kind[0x30:0x3A], kind[0x41:0x5B], kind[0x61:0x7B], kind[0x80:] = 1, 2, 3, 4
        shape = (np.minimum(ends - starts, 15).astype(np.uint64) * np.uint64(5) + kind[first]) * np.uint64(5) + kind[last]
        h = word_hashes(data, starts, ends)
        bounds = by_document(doc, part.num_rows)
        again = np.zeros(len(h), np.uint64)  # 1: seen before in the text, 2: equals the word before
        order = np.lexsort((np.arange(len(h)), h, doc))
        again[order[1:]] = ((h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])).astype(np.uint64)
        again[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])] = 2
        one = mix(shape * np.uint64(3) + again)
        both = mix(one[:-1] * np.uint64(31) + shape[1:] + np.uint64(1 << 33))
        ok = doc[1:] == doc[:-1]
        docs += [doc, doc[1:][ok]]
        ids += [one % np.uint64(DIM), both[ok] % np.uint64(DIM)]
        length = np.maximum(np.diff(bounds), 1)
        values += [1 / length[doc], 1 / length[doc[1:][ok]]]
    return np.concatenate(docs), np.concatenate(ids).astype(np.int64), np.concatenate(values)


def _fit(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    w, b = np.zeros(DIM), 0.0
    m, v, mb, vb = np.zeros(DIM), np.zeros(DIM), 0.0, 0.0
    vals = vals * 10
    for t in range(1, STEPS + 1):
        z = np.bincount(rows, weights=vals * w[cols], minlength=len(y)) + b
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / max(len(y), 1)
        g, gb = np.bincount(cols, weights=vals * r[rows], minlength=DIM) + L2 * w, r.sum()
        step = 0.1 * min(1, 2 * (1 - t / (STEPS + 1)))
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        b -= step * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    return (w * 10).astype(np.float32), b


def classify(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, posterior (of the votes), score (of the scorer) and predicted (1: good) for every row."""
    ballots = cut_lineage(votes(docs))  # three numbers a row, read three times
    counted = ballots.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most 3^labellers rows
    patterns, counts = counted.column("pattern").to_numpy().astype(np.int64), counted.column("n").to_numpy().astype(float)
    post, _, good = estimate(patterns, counts)
    spark = docs.sparkSession
    known = spark.createDataFrame([(int(p), float(q)) for p, q in zip(patterns, post)], "pattern int, posterior double")
    labelled = ballots.join(F.broadcast(known), "pattern").select("doc_id", "row_key", "posterior")

    chosen = (labelled.groupBy("doc_id", "row_key").agg(F.first("posterior").alias("posterior"))
              .orderBy(F.xxhash64("doc_id", "row_key"), "doc_id").limit(sample))
    texts = docs.select("doc_id", "text", row_key().alias("row_key")).alias("d")
    c = F.broadcast(chosen).alias("c")  # at most ``sample`` rows
    train = (texts.join(c, F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.row_key") == F.col("c.row_key")))
             .groupBy("c.doc_id", "c.row_key").agg(F.min(F.coalesce("d.text", F.lit(""))).alias("text"), F.first("c.posterior").alias("posterior")))  # repeated rows once

    def gather(batches):
        for batch in batches:
            for part in chunks(batch):
                doc, ids, values = shapes(part)
                key, at = np.unique(doc * DIM + ids, return_inverse=True)
                value = np.bincount(at, weights=values)
                cut = np.searchsorted(key // DIM, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("posterior"), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array((key % DIM).astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(value.astype(np.float32)))], names=["y", "cols", "vals"])

    got = train.mapInArrow(gather, "y double, cols array<int>, vals array<float>").toArrow()
    cols = got.column("cols").combine_chunks()
    rows = np.repeat(np.arange(got.num_rows), np.diff(cols.offsets.to_numpy())) if got.num_rows else np.zeros(0, np.int64)
    weights, intercept = _fit(rows, cols.flatten().to_numpy(), got.column("vals").combine_chunks().flatten().to_numpy().astype(float),
                              got.column("y").to_numpy())
    model = spark.sparkContext.broadcast((weights, intercept))  # DIM floats

    def score(batches):
        w, b = model.value
        for batch in batches:
            for part in chunks(batch):
                doc, ids, values = shapes(part)
                z = np.bincount(doc, weights=values * w[ids], minlength=part.num_rows) + b
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row_key"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                                                 names=["doc_id", "row_key", "score"])

    scored = docs.select("doc_id", "text", row_key().alias("row_key")).mapInArrow(score, "doc_id bigint, row_key bigint, score double").alias("s")
    one = labelled.groupBy("doc_id", "row_key").agg(F.first("posterior").alias("posterior")).alias("p")
    return (scored.join(one, F.col("s.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("s.row_key") == F.col("p.row_key")))
            .select("s.doc_id", "p.posterior", "s.score", (F.col("s.score") >= threshold).cast("int").alias("predicted")))


def report(docs: DataFrame) -> DataFrame:
    return classify(docs)
