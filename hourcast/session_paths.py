"""Scratch locations under the shared checkpoint folder (never a machine-local folder on a cluster)."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hourcast.session import ensure_checkpoint_dir, table_path


def scratch(spark: SparkSession, *parts: str) -> str:
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "hourcast-scratch", *parts)


def tag(*keys: str) -> str:
    return hashlib.sha1("|".join(keys).encode()).hexdigest()[:10]


def state_tag(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """Tag of what the tables hold now: names, sizes and modification times of their files, and the application.

    What is kept under it is shared within one run and made anew once a file comes, goes or changes. Only the
    file listing is read, no file's content.
    """
    keys = [sf_dir, spark.conf.get("spark.app.id", "")]
    for t in tables:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table_path(sf_dir, t))
        r = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime"))).alias("h")).first()
        keys += [t, str(r["n"]), str(r["h"])]
    return tag(*keys)
