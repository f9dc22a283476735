"""Training-data pipeline over ``documents``: five stages, each of which applies one operator to all that the one before kept.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``. ``run`` writes every stage's rows as Parquet into the shared
checkpoint folder and reads them again, so a lost executor never costs more than the stage at hand. A stage's folder
is removed once the next one is written; only the last one's stays for the result.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from hourcast.llm import decontaminate, jaccard_join, packing, secret_scan, toxicity
from hourcast.llm.textbatch import bounded_batches
from hourcast.session_paths import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from the labelled documents outside the held-out fold."""
    source = _table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.training_rows(source), _table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    bounded_batches(spark)
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows don't contaminate."""
    return decontaminate.remove_documents(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced; widely copied examples stay."""
    bounded_batches(spark)
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in training sequences, with the ids."""
    bounded_batches(spark)
    return packing.pack(docs, packing.tokenizer_path(), ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("harmonic_packing", pack_sequences),
]

# Model scores and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    base, before = scratch(spark, "pipeline", uuid.uuid4().hex), ""
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if i:
            _remove(spark, before)
        _forget(spark)
        before = path
    return docs


def _forget(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of frames that nothing refers to any more when the driver collects garbage: have it do so."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
