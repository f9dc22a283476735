import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from conftest import edge_rows
from hourcast.llm import piece_codec as C

PATH = C.model_path()


@pytest.fixture(scope="module")
def lib():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return C.PieceModel(PATH)


def encoded(own, texts):
    ids, bounds = own.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = ["abc de", "the in on re", "é中文 x\n", " ", "  a", "▁a ", "aA", "0123 .", "".join(map(chr, range(1, 127))),
               "".join(chr(rng.randint(1, 0xD7FF)) for _ in range(400)), "\U0001f600\U0001f9d1‍ é"]
    return ["".join(rng.choice(rng.choice(letters)) if k % 2 else rng.choice(letters[k % len(letters)]) for _ in range(rng.randint(0, 50))) for k in range(n)]


def test_encoding_equals_the_library(own, lib):
    texts = random_texts(6000)
    assert encoded(own, texts) == lib.encode(texts)


def test_merges_that_make_a_better_pair_come_first(own, lib):
    """Words in which the merge of one occurrence makes a pair of a better rank beside the next occurrence."""
    pieces = [lib.id_to_piece(i) for i in range(300, 3000) if len(lib.id_to_piece(i)) > 2]
    rng = random.Random(4)
    texts = ["".join(rng.choice(pieces).replace("▁", "") * rng.randint(1, 4) for _ in range(6)) for _ in range(3000)]
    assert encoded(own, texts) == lib.encode(texts)


@pytest.mark.parametrize("text", [" " * 9000, "a" * 9000, "the" * 5000, "x" + " " * 20 + "y", "中" * 5000, "\U0001f600" * 3000, "ab" * 4096 + " end"])
def test_long_words(own, lib, text):
    assert encoded(own, [text]) == [lib.encode(text)]


def test_long_texts_are_cut_in_blocks(own, lib, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 200)
    texts = [t * 20 for t in random_texts(60, seed=8)] + [" " * 3000, "a b" * 2000]
    assert encoded(own, texts) == lib.encode(texts)


def test_rounds_equal_one_merge_at_a_time(own, monkeypatch):
    texts = random_texts(300, seed=9)
    by_rounds = encoded(own, texts)
    monkeypatch.setattr(C, "LONG", 0)
    assert encoded(own, texts) == by_rounds


def test_decoding_equals_the_library(own, lib):
    rng = random.Random(6)
    lists = [[rng.choice([rng.randint(0, 258), rng.randint(0, 31_999), rng.randint(259, 300)]) for _ in range(rng.randint(0, 9))] for _ in range(5000)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    assert own.decode(np.array([i for x in lists for i in x], np.int64), bounds) == [lib.decode(x) for x in lists]
    with pytest.raises(ValueError):
        own.decode(np.array([32_000]), np.array([0, 1]))


def expected(lib, doc_id, text):
    ids = lib.encode(text or "") + [2]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids))


def test_report(edges, nothing, table, lib):
    rows = [(i, t) for i, t in enumerate(random_texts(200, seed=7))]
    assert sorted(map(tuple, C.report(table(rows)).collect())) == sorted(expected(lib, *r) for r in rows)
    assert sorted(map(str, map(tuple, C.report(edges).collect()))) == sorted(str(expected(lib, i, t)) for i, t, *_ in edge_rows())
    assert C.report(nothing).collect() == []


def test_frames_keep_their_columns(edges, lib):
    named = edges.withColumns({"ids": F.lit("x"), "decoded": F.lit("y"), "text_": F.lit("z")})
    got = C.encode(named, PATH, end=False)
    assert got.columns == [c for c in named.columns if c != "ids"] + ["ids"]
    assert all(r.ids == lib.encode(r.text or "") for r in got.collect())
    back = C.decode(got.withColumn("ids", F.when(F.col("doc_id") != 5, F.col("ids"))), PATH)
    assert all(r.decoded == ("" if r.doc_id in (5, None) else (r.text or "")) for r in back.collect())


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        C.PieceModel(str(tmp_path / "none.model"))
