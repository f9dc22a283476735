import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hourcast.llm import suffix_dedup as S
from hourcast.llm.textbatch import Rolling


def brute(rows, width):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(t[k:k + width] for _, t in texts for k in range(len(t) - width + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - width + 1):
            if seen[t[k:k + width]] > 1:
                gone[k:k + width] = b"\1" * width
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed, n=60):
    """Documents that share passages of every length around the width, with copies, near copies and runs."""
    rng = random.Random(seed)
    letters = "abcdé "
    base = "".join(rng.choice(letters) for _ in range(900))
    rows = []
    for i in range(n):
        own = "".join(rng.choice(letters) for _ in range(rng.randint(0, 300)))
        k = rng.randint(0, 5)
        if k < 3:
            a = rng.randint(0, 500)
            own += base[a:a + rng.randint(20, 200)] + own[:rng.randint(0, 60)]
        elif k == 3:
            own = base[:400] + rng.choice("xyz") + base[401:]
        elif k == 4:
            own = "ab" * rng.randint(10, 90) + own + "a" * rng.randint(0, 120)
        rows.append((i, own))
    return rows + [rows[5], rows[7], (None, rows[9][1]), (9, None), (500, "")]


@pytest.mark.parametrize("width,levels", [(40, (5, 2, 0)), (31, (5, 0)), (50, (0,))])
def test_equals_brute_force(table, width, levels):
    for seed in range(2):
        rows = passages(seed)
        got = [tuple(r) for r in S.report(table(rows), width, levels).collect()]
        assert sorted(got, key=str) == brute(rows, width)


def test_edges_at_full_width(edges):
    from conftest import edge_rows

    got = sorted((tuple(r) for r in S.report(edges).collect()), key=str)
    assert got == brute(edge_rows(), 400)


def test_lengths_of_what_is_kept(table):
    """A document without repeats keeps its own length, in bytes and characters; a repeated passage is missing from it."""
    passage = "".join(chr(233 + i % 7) + str(i % 10) for i in range(30))  # 30 letters of two bytes, 30 of one
    rows = [(1, "é" + passage), (2, passage + "ab"), (3, "déjà vu"), (4, None)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_bytes"], r["kept_chars"]) for r in S.left_over(table(rows), 40, (0,)).collect()}
    assert got == {1: (92, 90, 2, 1), 2: (92, 90, 2, 2), 3: (9, 0, 9, 7), 4: (0, 0, 0, 0)}


def test_empty(nothing):
    assert S.report(nothing).collect() == []


def test_difference_covers():
    for q in (2, 3, 5, 7, 13, 17):
        v, d = S.difference_cover(q)
        assert v == q * q + q + 1 and len(d) == q + 1
        assert {(i - j) % v for i in d for j in d} == set(range(v))


@pytest.mark.parametrize("pair", [
    ("cydnjpnanuspdwtvokrfbrekarbxovuu", "eagvuggpgswivtpmqqibjjgdjotxlnap"),
    ("iphahctdqwqbrpojlslafqpuqhewyjsz", "rtlttvgzwomjexchlrpfqeaaajtichzj"),
    ("qcafttvcqvbbolgdblcwkplaayqbhdiy", "hrqyaliwkaiithlwqoiynwycdhrlopny"),
])
def test_equal_keys_alone_remove_nothing(table, pair):
    """Different strings with one 48-bit key (found by search): the reach must tell them apart at the last level too."""
    keys = [Rolling.of_bytes(np.frombuffer(t.encode(), np.uint8), strong=True).spans(np.array([0]), np.array([32]))[0] >> np.uint64(16) for t in pair]
    assert keys[0] == keys[1]
    rows = [(1, pair[0]), (2, pair[1]), (3, pair[0] + "!")]
    for rows in (rows[:2], rows):
        assert sorted((tuple(r) for r in S.report(table(rows), 32, (0,)).collect()), key=str) == brute(rows, 32)
