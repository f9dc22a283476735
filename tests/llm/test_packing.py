import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourcast.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.tokenizer_path())


def check(rows, got, tokenizer, capacity=4096, ids=False):
    """Exact round trip: pieces of each document give its ids again; sequences are gapless and not over-full."""
    want = sorted((str(i), np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t, *_ in rows)
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for pieces in seqs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sorted(seqs) == list(range(len(seqs)))
    if ids:
        back = []
        for i, pieces in docs.items():
            starts = defaultdict(list)
            for r in pieces:
                assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
                starts[r.start].append(r)
            if all(len(v) == 1 for v in starts.values()):
                back.append((str(i), b"".join(np.array(starts[s][0].ids, "<u4").tobytes() for s in sorted(starts))))
        single = [w for w in want if sum(x[0] == w[0] for x in want) == 1]
        assert sorted(b for b in back if b[0] in {w[0] for w in single}) == single
    assert sum(r.length for r in got) == sum(len(w[1]) // 4 for w in want)
    return sum(r.length for r in got) / (len(seqs) * capacity)


def test_round_trip(table, tokenizer):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeé'1.中") for _ in range(rng.randint(1, 9)))
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(word() for _ in range(rng.choice([0, 3, 40, 400, 2500])))) for i in range(150)]
    got = P.pack(table(rows), P.tokenizer_path(), ids=True).collect()
    assert check(rows, got, tokenizer, ids=True) > 0.9


def test_edges(edges, nothing, tokenizer):
    from conftest import edge_rows

    check(edge_rows(), P.pack(edges, P.tokenizer_path(), ids=True).collect(), tokenizer, ids=True)
    assert P.report(nothing).collect() == []


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="aB.,' <|>1é\u0301\u030cJ\n\u2026", max_size=40)), max_size=4))
def test_word_by_word_equals_whole(texts):
    words = test_word_by_word_equals_whole.__dict__.setdefault("words", P.WordTokenizer(P.tokenizer_path()))
    ids, bounds = words.encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.integers(1, 30_000))
def test_cuts(n):
    out = P.cuts(n)
    assert sum(out) == n and all(0 < x <= 4096 for x in out)
    last = out[-1]
    place = 4096 // (4096 // last)
    assert last >= (1 - P.SLACK) * place or last == place
