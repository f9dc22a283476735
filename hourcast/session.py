"""Session helpers: building a session for scripts and tests, and lineage cuts.

Nothing here overrides settings a cluster already provides: the checkpoint folder is read from
``spark.checkpoint.dir`` and only set when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on; a cluster may override the sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "hourcast",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if os.environ.get("HOURCAST_SESSION_TZ"):  # robustness runs: results must not depend on it
        b = b.config("spark.sql.session.timeZone", os.environ["HOURCAST_SESSION_TZ"])
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only when none is configured."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server owns the checkpoint folder)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="hourcast-ckpt-")  # one process: its own folder is shared
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its file system (local, HDFS, object store)? Errors propagate."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
