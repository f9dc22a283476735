"""The registered queries of the numbered operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import (decontaminate, fill_in_middle, jaccard_join, language_id, packing, piece_codec, prefix_trie, quality_rules, secret_scan,
                          sharding, suffix_dedup, toxicity, weak_quality)
from hourcast.llm.oracles import ORACLE_SQL
from hourcast.llm.textbatch import bounded_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_table(spark, sf_dir, "documents"))


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.left_over(_table(spark, sf_dir, "documents"))
    return done.withColumn("repeated", F.col("n_removed") > 0)  # the document loses bytes


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_ngram_jaccard_join": _documents(jaccard_join.report),
        "op3_language_id": _documents(language_id.report),
        "op4_toxicity": op4_toxicity,
        "op5_quality_classifier": _documents(weak_quality.report),
        "op6_secret_scan": _documents(secret_scan.report),
        "op7_histogram_sharding": _documents(sharding.report),
        "op8_quality_rules": _documents(quality_rules.report),
        "op9_harmonic_packing": _documents(packing.report),
        "op10_benchmark_decontamination": op10_benchmark_decontamination,
        "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
        "op12_fill_in_middle": _documents(fill_in_middle.report),
        "op13_sentencepiece": _documents(piece_codec.report),
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
