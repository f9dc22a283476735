import random
import zlib

from hourcast.llm import sharding as H


def check(rows, got, shards=16):
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert all(0 <= s < shards for s in by)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by.values())
    assert {r.law for r in got} <= {"bytes"} and {r.grown_shard for r in got} <= {None}
    return {s: sum(r.size for r in by.get(s, [])) for s in range(shards)}


def test_sizes_are_near_equal_with_a_hot_group(table):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 60)) for i in range(2000)] + [(5000 + i, "one text that a third of all rows have") for i in range(1000)]
    size = check(rows, H.report(table(rows)).collect())
    mean = sum(size.values()) / 16
    assert all(abs(s - mean) <= 0.05 * mean for s in size.values())


def test_equal_texts_lie_together(table):
    rows = [(i, f"text {i % 300}") for i in range(1200)]
    got = H.shard(table(rows)).collect()
    spread = {}
    for r in got:
        spread.setdefault(r.text, set()).add(r.shard)
    assert sum(len(s) > 1 for s in spread.values()) <= 15  # only groups under a splitter


def test_edges(edges, nothing):
    from conftest import edge_rows

    check(edge_rows(), H.report(edges).collect())
    assert H.report(nothing).collect() == []
    assert H.shard(edges).columns == [*edges.columns, "shard", "slot"]
    got = H.shard(H.shard(edges), shards=3)
    assert got.columns == [*edges.columns, "shard", "slot"] and got.where("shard > 2").count() == 0


def test_splitters_meet_tolerance(table):
    from pyspark.sql import functions as F

    rows = H.keyed(table([(i, "y" * (i % 50)) for i in range(3000)]))
    keys, below = H.splitters(rows, 8, tolerance=0.01)
    total = rows.agg(F.sum("__size")).first()[0]
    for i, (k, n) in enumerate(zip(keys, below), 1):
        got = rows.where(F.col("__key") < int(k)).agg(F.sum("__size"), F.count("*")).first()
        assert abs(got[0] - total * i / 8) <= 0.01 * total / 8 + 50 and got[1] == n


def test_columns_with_helper_names(clashing, edges):
    out = H.shard(clashing)
    assert out.columns == [*clashing.columns, "shard", "slot"]
    assert sorted(map(str, out.select("doc_id", "text", "shard", "slot").collect())) == sorted(map(str, H.shard(edges).select("doc_id", "text", "shard", "slot").collect()))
    assert out.select(*clashing.columns[4:]).distinct().count() == 1


def test_placing_equals_a_slow_reference(table):
    """All rows sorted by (key, doc_id, hash) in one place: shards are consecutive runs of equal bytes, slots count within them."""
    rng = random.Random(9)
    rows = [(i, "y" * rng.randint(0, 400)) for i in range(1500)] + [(9000 + i, "the same text " * 5) for i in range(400)] + [(1, None)] * 3
    docs = table(rows)
    order = sorted(((r["__key"], r.doc_id, r["__tie"], r["__size"]) for r in H.keyed(docs).collect()))
    got = {}
    for r in H.keyed(H.shard(docs, shards=7)).collect():
        got.setdefault((r["__key"], r.doc_id, r["__tie"]), []).append((r.shard, r.slot))
    total, below, last, slot = sum(o[3] for o in order), 0, 0, 0
    for key, doc_id, tie, size in order:
        at = sorted(got[key, doc_id, tie]).pop(0)
        got[key, doc_id, tie].remove(at)
        slot = 0 if at[0] != last else slot
        assert at == (at[0], slot) and at[0] - last in (0, 1)
        if at[0] != last:  # a splitter: the bytes below it are near its goal
            assert abs(below - total * at[0] / 7) <= 0.01 * total / 7 + 401
        last, slot, below = at[0], slot + 1, below + size
    assert last == 6
