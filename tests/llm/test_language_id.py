import random
import zlib

import numpy as np

from hourcast.llm import language_id as L

WORDS = {"en": "the of and to in that was with", "de": "der die und ist nicht mit von für", "fr": "le la et est que avec des pour"}


def rows(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(40)), lang))
    return out


def test_held_out_accuracy(table):
    data = rows(120)
    got = {r.doc_id: r for r in L.report(table(data)).collect()}
    assert {i for i, r in got.items() if r.held_out} == {i for i, *_ in data if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(got[i].lang_pred == lang and 0 < got[i].score <= 1 for i, _, lang in data)


def test_edges(table, nothing):
    data = rows(60) + [(1000, None, "en"), (1001, "", None), (1002, "12 34 !?", "de"), (1003, "中文", None), (None, "der die und", "de"), (None, "der die und", "de")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.report(table(data)).collect()]
    by = {g[0]: g for g in got}
    assert len(got) == len(data)
    assert by[1000][1:] == by[1001][1:] == by[1002][1:] == ("und", 0.0)
    assert by[1003][1] in WORDS and by[1003][2] == 0.0
    assert [g[1] for g in got if g[0] is None] == ["de", "de"]
    assert L.report(nothing).collect() == []
    assert {r.lang_pred for r in L.report(table([(1, "a text"), (2, None)])).collect()} == {"und"}


def test_labels_of_the_held_out_fold_teach_nothing(table):
    data = rows(80)
    changed = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in data]
    assert sorted(L.report(table(data)).collect()) == sorted(L.report(table(changed)).collect())


def test_filter_returns_all_languages_of_a_gram(spark, table):
    langs = [f"l{i:02d}" for i in range(70)]  # more than one word of bits
    data = [(i, "common " + chr(0x4E00 + i) * 9, lang) for i, lang in enumerate(langs)]
    model = L.fit(table(data))
    gram, doc, _ = L.ngrams(["common"])
    shares = model.shares(gram, doc, 1)[0]
    assert len(model.langs) == 70 and np.all(shares > 0.9)
    gram, doc, _ = L.ngrams([chr(0x4E00 + 66) * 9])
    assert model.shares(gram, doc, 1)[0].argmax() == 66


def slow_grams(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            padded = "\0" + word + "\0"
            out += [padded[i:i + n] for n in L.GRAMS for i in range(len(padded) - n + 1)]
            word = ""
    return out


def test_predictions_equal_exact_membership(table):
    """A slow reference with sets instead of the filter: the filter's false positives are taken out of the shares."""
    rng = random.Random(11)
    mixed = lambda: " ".join(rng.choice(WORDS[rng.choice(sorted(WORDS))].split()) + rng.choice(["", ".", "-x", "é"]) for _ in range(25))
    data = rows(80, seed=4) + [(2000 + i, mixed(), None) for i in range(60)] + [(3000, "zzz qqq", None), (3001, "a", None), (3002, "Über ÉTÉ", None)]
    counts = {}
    for i, t, lang in data:
        if lang and zlib.crc32(str(i).encode()) % 4 != 2:
            for g in slow_grams(t):
                counts.setdefault(lang, {}).setdefault(g, 0)
                counts[lang][g] += 1
    totals = {k: sum(c.values()) for k, c in counts.items()}
    known = {k: {g for g, n in c.items() if n >= totals[k] * L.MIN_SHARE} for k, c in counts.items()}
    for r in L.report(table(data)).collect():
        grams = slow_grams(dict((i, t) for i, t, _ in data)[r.doc_id])
        share = {k: sum(g in known[k] for g in grams) / max(len(grams), 1) for k in sorted(known)}
        best = max(sorted(share), key=lambda k: share[k])
        if not sum(share.values()):
            assert r.score == 0 and r.lang_pred == max(totals, key=totals.get)
            continue
        runner_up = sorted(share.values())[-2]
        assert abs(r.score - share[best] / sum(share.values())) < 1e-3
        assert r.lang_pred == best or share[best] - runner_up < 1e-3
