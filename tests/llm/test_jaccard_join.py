import random
import re
from collections import Counter

import pytest

from hourcast.llm import jaccard_join as J
from hourcast.llm.components import connected

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, share=80):
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return Counter((d, len(s), least.get(root(i)) if s else d) for i, (d, s) in enumerate(sets))


def clusters(seed, n=160):
    """Near copies with edits around the threshold, shared passages, short texts and truncated ones."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    bases, passage, rows = [text(rng.randint(40, 120)) for _ in range(6)], text(25), []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        k = rng.randint(0, 6)
        if k == 0:
            w = w[:int(len(w) * rng.uniform(0.7, 1))]
        elif k == 1:
            w = text(rng.randint(0, 60)) + passage + text(rng.randint(0, 60))
        elif k == 2:
            w = text(rng.randint(0, 6))
        rows.append((i, rng.choice(["\n", " ", "\x0b"]).join(x.upper() if rng.random() < 0.1 else x for x in w)))
    return rows


def rows_of(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("block", [256, 4])
def test_equals_brute_force(table, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)  # small blocks: hub round, large components, several blocks of a group
    monkeypatch.setattr(J, "QUERIES", 16)
    rows = clusters(block)
    assert rows_of(J.report(table(rows))) == brute(rows)


def test_hot_shingles_change_no_result(table, monkeypatch):
    import numpy as np

    rows = clusters(9, 60)
    monkeypatch.setattr(J, "hot_shingles", lambda *a, **k: np.zeros(0, np.uint64))
    assert rows_of(J.report(table(rows))) == brute(rows)


def test_edges(edges, nothing):
    from conftest import edge_rows

    assert rows_of(J.report(edges)) == brute(edge_rows())
    assert J.report(nothing).collect() == []


def test_keep_one(edges):
    kept = J.keep_one(edges)
    assert kept.columns == edges.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 10, 11]
    assert sorted(str(r.text) for r in rows if r.doc_id is None) == ["None", "no id at all"]


def test_keep_one_without_ids(table):
    texts = ["one text of more than five words", "another text of more than five words", "one text of more than five words", None, None]
    kept = sorted(str(r.text) for r in J.keep_one(table([(None, t) for t in texts])).collect())
    assert kept == ["None", "None", "another text of more than five words", "one text of more than five words"]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (102, 100), (7, 7)]
    got = dict(connected(spark.createDataFrame(edges, "a int, b int")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_columns_with_helper_names(clashing, edges):
    out = J.keep_one(clashing)
    assert out.columns == clashing.columns
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, J.keep_one(edges).select("doc_id", "text").collect()))
    assert out.select(*clashing.columns[4:]).distinct().count() == 1


def near_copies(n, seed=1):
    """A third of all documents are near copies of one text, each with a text of its own."""
    rng = random.Random(seed)
    vocabulary = ["v%d" % i for i in range(5000)]
    text = [rng.choice(vocabulary) for _ in range(90)]
    rows = []
    for i in range(n):
        if i % 3:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 60))]
        else:
            w = list(text)
            w[rng.randrange(len(w))] = f"own{i}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("split", [4, 11])
def test_lists_of_hot_shingles_are_dealt_to_several_buckets(table, monkeypatch, split):
    monkeypatch.setattr(J, "SPLIT", split)
    monkeypatch.setattr(J, "BLOCK", 16)
    for rows in (near_copies(240), clusters(5)):
        docs = table(rows)
        hot = J.hot_shingles(docs)
        assert (hot.counts >= split).any()
        assert rows_of(J.report(docs)) == brute(rows)


def test_long_sets_fill_blocks_by_their_shingles(table, monkeypatch):
    monkeypatch.setattr(J, "GROUP_SHINGLES", 300)
    rows = near_copies(120)
    assert rows_of(J.report(table(rows))) == brute(rows)


def test_bucket_keys_fill_every_partition(table):
    import numpy as np
    from pyspark.sql import functions as F

    from hourcast.llm import spill

    docs = table([(i, "x" * 1000) for i in range(300)])
    for size in (1 << 20, 2000):
        keys = spill.bucket_keys(docs, bucket_bytes=size)
        assert len(keys) == max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-300_000 // size))
        df = docs.sparkSession.createDataFrame([(int(k),) for k in keys], "bucket int").repartition(len(keys), "bucket")
        assert df.select(F.spark_partition_id()).distinct().count() == len(keys) == len(np.unique(keys))
