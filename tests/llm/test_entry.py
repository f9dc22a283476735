import re

import corpus_pipeline
from hourcast.llm.queries import oracle_sql, queries


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


def test_pipeline_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "harmonic_packing"]
