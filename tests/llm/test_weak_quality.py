import random
import re

import numpy as np

from hourcast.llm import weak_quality as W


def test_em_finds_labellers(monkeypatch):
    """Votes drawn from known accuracies: EM must find the class of patterns and who votes well."""
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.7
    accuracy = [0.95, 0.9, 0.85, 0.9, 0.6, 0.8, 0.9]
    pattern = np.zeros(len(truth), np.int64)
    for j, a in enumerate(accuracy):
        vote = np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int)
        vote[rng.random(len(truth)) < 0.2] = W.ABSTAIN
        pattern += vote * 3 ** j
    patterns, at, counts = np.unique(pattern, return_inverse=True, return_counts=True)
    post, table, good = W.estimate(patterns, counts.astype(float))
    assert abs(good - 0.7) < 0.03
    assert ((post[at] >= 0.5) == truth).mean() > 0.97
    found = [table[j, 1, 1] / (table[j, 1, 1] + table[j, 1, 0]) for j in range(len(accuracy))]
    assert np.abs(np.array(found) - accuracy).max() < 0.05


def test_junk_and_prose(table):
    rng = random.Random(2)
    prose = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) + ("." if k % 9 == 8 else "") for k in range(120))
    rows = [(i, prose()) for i in range(60)] + [(100 + i, "Buy now | " * 60) for i in range(15)] + [(200 + i, "# $ % & * 11 22") for i in range(15)]
    got = {r.doc_id: r for r in W.report(table(rows)).collect()}
    assert all(r.predicted == 1 for i, r in got.items() if i < 60)
    assert all(r.predicted == 0 for i, r in got.items() if i >= 100)
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got.values())


def test_edges(edges, nothing):
    assert len(W.report(edges).collect()) == edges.count()
    assert W.report(nothing).collect() == []


def slow_votes(text):
    """The labellers on one text, in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, chars = len(words), sum(map(len, words))
    seen = {}
    for i in range(n - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    repeat = len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = len(lines) - len(set(lines))
    symbols, stops = sum(c in "#*$%&|<>" for c in text), sum(c in ".!?" for c in text)
    letters = sum(c.isalpha() for c in text)
    rules = [(n < 30, n >= 80), (n > 0 and repeat > 0.25 * n, n > 0 and repeat < 0.05 * n), (len(lines) > 1 and dup > 0.2 * len(lines), len(lines) > 1 and dup == 0),
             (n > 0 and symbols > 0.05 * n, n > 0 and symbols == 0), (n > 0 and (chars < 3 * n or chars > 11 * n), n > 0 and 4 * n <= chars <= 8 * n),
             (n >= 30 and stops < 0.01 * n, n > 0 and stops >= 0.03 * n), (chars > 0 and letters < 0.8 * chars, chars > 0 and letters >= 0.9 * chars)]
    return tuple(0 if bad else 1 if good else 2 for bad, good in rules)


def slow_posteriors(ballots):
    """EM over single texts, not counts."""
    table = [[[0.5, 0.2, 0.3], [0.2, 0.5, 0.3]] for _ in W.LABELLERS]
    good, post = 0.7, []
    kinds = sorted(set(ballots))
    count = {k: ballots.count(k) for k in kinds}
    for _ in range(W.EM_STEPS):
        post = {}
        for k in kinds:
            p = [1 - good, good]
            for j, v in enumerate(k):
                p = [p[0] * table[j][0][v], p[1] * table[j][1][v]]
            post[k] = p[1] / (p[0] + p[1])
        good = min(max(sum(post[k] * count[k] for k in kinds) / len(ballots), 0.02), 0.98)
        for c in (0, 1):
            weight = {k: count[k] * (post[k] if c else 1 - post[k]) for k in kinds}
            total = sum(weight.values())
            for j in range(len(table)):
                table[j][c] = [(sum(w for k, w in weight.items() if k[j] == v) + 1) / (total + 3) for v in range(3)]
    return [post[k] for k in ballots]


def slow_features(text):
    """{feature: value} of one text, word by word."""
    h = lambda x: int(W.mix(np.array([x % (1 << 64)], np.uint64))[0])
    kind = lambda c: 1 if 0x30 <= c < 0x3A else 2 if 0x41 <= c < 0x5B else 3 if 0x61 <= c < 0x7B else 4 if c >= 0x80 else 0
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    n, out = len(words), {}
    size = int(np.floor(2 * np.log2(n))) if n else 0
    out[h(size + (7 << 40)) % W.DIM] = 1.0
    before, seen = None, set()
    for i, w in enumerate(words):
        shape = (min(len(w), 15) * 5 + kind(w[0])) * 5 + kind(w[-1])
        again = 2 if i and words[i - 1] == w else 1 if w in seen else 0
        seen.add(w)
        one = h(shape * 3 + again)
        for f, v in [(one, 1 / n)] + ([(h(before * 31 + shape + (1 << 33)), 1 / n)] if i else []):
            out[f % W.DIM] = out.get(f % W.DIM, 0) + v
        before = one
    return out


def test_posteriors_and_scores_equal_a_slow_reference(table):
    rng = random.Random(8)
    letters = ["abcdefgh ", "abcde fgh.", "ab #|1 ", "é ü. ", "a\n", "aaa bbb "]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 700))) for a in letters for _ in range(25)] + ["same line.\n" * 12, "x y z " * 50, ""]
    got = {r.doc_id: r for r in W.report(table(list(enumerate(texts)))).collect()}
    ballots = [slow_votes(t) for t in texts]
    posts = slow_posteriors(ballots)
    assert all(abs(got[i].posterior - p) < 1e-9 for i, p in enumerate(posts))
    feats = [slow_features(t) for t in texts]
    flat = [(i, f, v) for i, x in enumerate(feats) for f, v in sorted(x.items())]
    w, b = W._fit(*(np.array(c) for c in zip(*flat)), np.array(posts))
    for i, x in enumerate(feats):
        z = b + sum(float(w[f]) * v for f, v in x.items())
        assert abs(got[i].score - 1 / (1 + np.exp(-z))) < 2e-3
        assert got[i].predicted == (got[i].score >= W.THRESHOLD)


def test_repeated_rows_teach_once(table):
    rows = [(i, "word " * (20 + i)) for i in range(30)]
    a = {r.doc_id: r.score for r in W.report(table(rows)).collect()}
    assert len(W.report(table(rows + [rows[3]] * 40)).collect()) == 70 and len(a) == 30
