import random
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_jaccard_join import brute as jaccard  # noqa: E402
from test_packing import check  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    test = [(i, text(20)) for i in range(5)]
    rows, labels = [], []
    for i in range(300):
        t, toxic = text(60), int(i % 5 == 0)
        if toxic:
            w = t.split()
            w[4], w[20], w[40] = "vilest", "scummiest", "vilest"
            t = " ".join(w)
        rows.append((i, t, "en", f"s{i % 7}", len(t)))
        labels.append((i, 1, toxic))
    rows += [(400 + i, rows[10 * i + 1][1] + " extra", "en", "s", 1) for i in range(10)]  # near copies
    rows += [(500 + i, rows[1][1], "en", "s", 1) for i in range(20)]  # copies
    rows += [(600 + i, text(30) + " " + t.upper() + " " + text(30), "en", "s", 1) for i, t in test]  # contaminated
    rows += [(700, text(60) + " password = gh9Kx2Lm4Pq8Rt6Vw1Zy", "en", "s", 1), (701, "", "en", "s", 0), (702, None, None, None, None), (702, None, None, None, None)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(test, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, labels


def test_every_stage(spark, folder, tmp_path):
    path, rows, labels = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs.collect())
    toxic = {i for i, _, y in labels if y}
    ids = [{r.doc_id for r in k} for k in kept]
    assert ids[0] == {r[0] for r in rows} - toxic
    assert ids[1] == {c for _, _, c in jaccard([tuple(r)[:2] for r in kept[0]])}
    assert ids[2] == ids[1] - set(range(600, 605))
    assert ids[3] == ids[2] and ids[4] == ids[3]
    texts = {r.doc_id: r.text for r in kept[3]}
    assert texts[700].endswith("[SECRET]") and "gh9Kx2" not in texts[700]
    assert all(texts[r.doc_id] == r.text for r in kept[2] if r.doc_id != 700)
    from hourcast.llm.packing import tokenizer_path
    from tokenizers import Tokenizer

    check([tuple(r)[:2] for r in kept[3]], kept[4], Tokenizer.from_file(tokenizer_path()), ids=True)


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset", "ids_crc32"} <= set(out.columns)
    assert re.fullmatch(r"[a-z_]+", corpus_pipeline.STAGES[0][0])
