import random

import pytest
from pyspark.sql import functions as F

from brute_trie import brute, nodes_of, own_turns
from hourcast.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, d int, s string, rep string, n string, part string, leaves string"


@pytest.fixture(scope="module")
def talk(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, "x", "y", "z", "p", "q") for r in rows], SCHEMA).repartition(3)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(-1 if x is None else x for x in r))


def random_rows(rng, convs, turns=9, words=3):
    rows = []
    for c in rng.sample(range(0, 1200), convs):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "c d", ""][:words + 1])) for t in range(rng.randint(1, turns))]
    rng.shuffle(rows)
    return rows


def edge_rows():
    return [(0, 0, "user", "hi"), (0, 0, "user", "hi"), (0, None, None, "first"), (0, None, None, None), (0, 5, "assistant", "é" * 3),
            (5, 1, "user", "x" * 50_000), (5, 2, None, "end"), (None, 1, "user", "no conversation"), (7, None, "", ""), (-5, 1, "user", "below"),
            (-100, 1, "user", "shared"), (-100, 2, "user", "more"), (-103, 1, "a", "b"), (150, 1, "u", "only own"), (100, 1, "u", "t"), (100, 1, "u", "t")]


def test_report_equals_brute_force(talk):
    rng = random.Random(1)
    for convs in (1, 60, 300):
        rows = random_rows(rng, convs)
        assert ordered(P.report(talk(rows)).collect()) == ordered(brute(rows))


def test_edges(talk):
    assert ordered(P.report(talk(edge_rows())).collect()) == ordered(brute(edge_rows()))
    assert P.report(talk([])).collect() == []
    assert ordered(P.report(talk([(None, 1, "u", "t")])).collect()) == []


def test_bands_copies_and_spilling(talk, monkeypatch):
    """Long conversations over many bands, conversations that each grow out of the last one, and a third of copies."""
    monkeypatch.setattr(P, "BAND", 4)
    monkeypatch.setattr(P, "IDS", 3)
    rows = [(700 + c, t, "u", "same") for c in range(40) for t in range(6)]
    rows += [(c, t, "u", f"step {t}") for c in range(30) for t in range(c + 1)]
    rows += [(900, t, "u", f"long {t}") for t in range(300)] + [(901, t, "u", f"long {t}") for t in range(150)] + [(902, 151, "u", "end")]
    convs = own_turns(rows)
    turns = P.ordered_turns(talk(rows))
    nodes, ends = P.trie(turns.withColumn("part_no", F.lit(0)), turns.where("pos = 1").select("conv_id"), limit=8)
    got = nodes.join(P.members_digest(ends), P.NODE, "left").select(
        "conv_id", F.col("d"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    assert ordered(got.collect()) == ordered(nodes_of(convs))
    assert ordered(P.report(talk(rows)).collect()) == ordered(brute(rows))


def test_nodes_with_their_turns(talk):
    rows = random_rows(random.Random(2), 40) + edge_rows()[:7]
    nodes, ends = P.conversation_trie(talk(rows))
    own = own_turns(rows)
    got = P.with_turns(nodes, talk(rows)).collect()
    assert len(got) == len(nodes_of(own)) and all((r.role, r.text) == ((None, None) if r.d == 0 else own[r.conv_id][r.d - 1]) for r in got)
    assert {(r.conv_id, r.d) for r in ends.collect()} == {(c, len(t)) for c, t in own.items()}


def test_spilling_queue_pops_in_order():
    rng = random.Random(3)
    items = [(rng.randint(-50, 50), rng.randint(0, 9), rng.randint(0, 99), i) for i in range(3000)]
    queue, got, waiting = P.SpillingQueue(4, limit=40), [], sorted(items)
    for i, item in enumerate(items):
        queue.push(item)
        if i == 2000:
            assert len(queue.heap) <= 41 and queue.runs
    for key in [(-40,), (-40, 5), (0, 3), (50, 9)]:
        got = list(queue.pop_until(key))
        expected = [x for x in waiting if x[:len(key)] <= key]
        assert got == expected
        waiting = waiting[len(expected):]
    assert not waiting and not queue.heap and not queue.runs


def test_shards_split_a_hot_conversation(talk, monkeypatch):
    """Rows of one conversation lie in many partitions, before and after the running sums."""
    monkeypatch.setattr(P, "BAND", 64)
    rows = [(3, t, "u", f"{t}") for t in range(4000)]
    turns = P.ordered_turns(talk(rows))
    assert turns.select(F.spark_partition_id()).distinct().count() > 4
    assert [r.pos for r in turns.orderBy("pos").collect()] == list(range(1, 4001))
