"""Packed records: numpy columns of many records in one binary cell, keyed by a bucket.

A task packs the records of a flush by bucket, so a shuffle moves a few large cells instead of many
small rows, and a bucket is unpacked, sorted and settled on its own.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.textbatch import give_back


BUCKET_BYTES = 16 << 20  # of text behind the records of a bucket


def bucket_keys(docs: DataFrame, text: str = "text", bucket_bytes: int = BUCKET_BYTES, per_partition: int = 2) -> np.ndarray:
    """A key for each bucket; ``repartition(len(keys), "bucket")`` gives every bucket a partition of its own.

    There are as many buckets as the texts' bytes ask for, ``per_partition`` for each shuffle partition at least, so a
    bucket's size does not grow with the input.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(per_partition * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    # Of the first numbers one for each partition that hash partitioning deals them to; 16 n leave e^-16 of them without.
    at = F.pmod(F.hash(F.col("k")), F.lit(n)).alias("part")
    found = spark.range(16 * n).select(F.col("id").cast("int").alias("k")).select("k", at).groupBy("part").agg(F.min("k").alias("k"))
    return np.array(sorted(r["k"] for r in found.collect()), np.int32)  # n numbers


def pack(token: np.ndarray, records: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket key, bytes) of a structured array, dealt by ``token``, in bucket order."""
    bucket = keys[(token % np.uint64(len(keys))).astype(np.int64)]
    order = np.argsort(bucket, kind="stable")
    bucket, records = bucket[order], records[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for part, b in zip(np.split(records, cuts), bucket[np.concatenate([[0], cuts])] if len(bucket) else []):
        yield int(b), part.tobytes()


def forget(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of frames that nothing refers to any more when the driver collects garbage: have it do so."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def packed_batch(cells: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in cells], pa.int32()), pa.array([x for _, x in cells], pa.binary())],
                                      names=["bucket", "cell"])


def unpack(table: pa.Table, dtype: np.dtype) -> np.ndarray:
    give_back()
    return np.frombuffer(b"".join(table.column("cell").to_pylist()), dtype)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal keys in sorted columns."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
