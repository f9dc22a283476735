import random
import zlib

from hourcast.llm import toxicity as T


def corpus(n=400, seed=1):
    """Half of the toxic sentences name one group; neutral sentences name another or none."""
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(30)]
        toxic = int(rng.random() < 0.3)
        if toxic:
            w[3], w[9] = rng.choice(["vile", "scummy"]), rng.choice(["vile", "awful"])
            if rng.random() < 0.6:
                w[5] = "muslim"
        elif rng.random() < 0.3:
            w[5] = "christian"
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, toxic))
    return rows, labels


def table_of_labels(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out(spark, table):
    rows, labels = corpus()
    got = {r.doc_id: r for r in T.report(table(rows), table_of_labels(spark, labels)).collect()}
    assert {i for i, r in got.items() if r.held_out} == {i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())
    right = [got[i].predicted == y for i, y in labels if got[i].held_out]
    assert sum(right) >= 0.97 * len(right)


def test_swapping_identity_terms_changes_little(spark, table):
    rows, labels = corpus()
    docs, marks = table(rows), table_of_labels(spark, labels)
    gap = lambda m: abs(m.scores(["word1 muslim word2"])[0] - m.scores(["word1 christian word2"])[0])
    with_, without = T.fit(docs, marks), T.fit(docs, marks, swap=0.0)
    assert gap(with_) < 0.02 and gap(with_) < gap(without)
    assert with_.scores(["word1 muslim word2 word3"])[0] < 0.7


def test_edges(spark, table, edges, nothing):
    rows, labels = corpus(150)
    model = T.fit(table(rows), table_of_labels(spark, labels + [(3, 1), (3, 0), (None, 1), (9999, None)]))
    got = T.score(edges, model).collect()
    assert len(got) == edges.count() and all(0 <= r.score <= 1 for r in got)
    assert T.keep_clean(edges, model).columns == edges.columns
    assert T.keep_clean(edges, model).count() == edges.count()
    assert T.score(nothing, model).collect() == []
    unfitted = T.fit(table(rows), table_of_labels(spark, []))
    assert {r.score for r in T.score(edges, unfitted).collect()} == {0.0}


def test_held_out_labels_teach_nothing(spark, table):
    rows, labels = corpus(200)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a = T.report(table(rows), table_of_labels(spark, labels)).collect()
    b = T.report(table(rows), table_of_labels(spark, turned)).collect()
    assert sorted(a) == sorted(b)


def test_sample_counts_training_rows_and_one_text_for_each_id(spark, table):
    """The bound is on rows that can be learnt from: labels of held-out or unknown ids take no place in it."""
    rows, labels = corpus(300)
    docs = table(rows + [(2, "another text of the same id"), (2, rows[2][1])] * 5)
    more = labels + [(i, i % 2) for i in range(10_000, 13_000)]
    got = T._sample(T.training_rows(docs), table_of_labels(spark, more), "toxic", 150).collect()
    assert len(got) == len({r.doc_id for r in got}) == 150
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id < 300 for r in got)
    every = T._sample(T.training_rows(docs), table_of_labels(spark, more), "toxic", 10_000).collect()
    assert {r.doc_id for r in every} == {i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1}


def test_no_feature_is_capped(spark, table):
    """Features that tell the labels apart all take part, however many there are."""
    rng = random.Random(2)
    signal = ["".join(rng.choice("bcdfghjklm") for _ in range(9)) for _ in range(2500)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        rows.append((i, " ".join([f"plain{rng.randint(0, 50)}" for _ in range(20)] + (rng.sample(signal, 700) if toxic else [])), "en", "s"))
        labels.append((i, toxic))
    model = T.fit(table(rows), table_of_labels(spark, labels))
    assert int((model.weights != 0).sum()) > 4096


def test_scores_equal_a_slow_reference(spark, table):
    """Score = logistic of the intercept and the weights of every word and word beginning, at its rate in 100 words."""
    import math

    import numpy as np

    rows, labels = corpus(200)
    model = T.fit(table(rows), table_of_labels(spark, labels))
    texts = [r[1] for r in rows[:40]] + ["", "  ", "Vile VILE vile é-x 12 scummy", "muslim christian"]

    def words(t):
        out, w = [], ""
        for c in t.lower() + " ":
            if "a" <= c <= "z" or ord(c) > 127:
                w += c
            elif w:
                out.append(w)
                w = ""
        return out

    def weight(w):
        ids = T.features([w])[0]  # one word: itself and its beginnings
        assert len(ids) == 1 + sum(len(w.encode()) > k for k in T.BEGINNINGS)
        return sum(float(model.weights[i]) for i in ids)

    for t, s in zip(texts, model.scores(texts)):
        ws = words(t)
        z = model.intercept + sum(weight(w) for w in ws) * 100 / (len(ws) + T.SMOOTH)
        assert abs(s - 1 / (1 + math.exp(-z))) < 1e-6
    assert np.isfinite(model.weights).all()
