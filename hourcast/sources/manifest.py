"""A day lake whose merges are all or nothing (S9): days are written aside, and one manifest says which files count.

Layout: ``root/data/batch=<id>/year=/month=/day=/part-*.parquet`` and ``root/manifests/<number>``, a small table with one row
for each day (year, month, day, batch). A merge writes the new state of the days it touches into a batch of its own and
then the next manifest; nothing that a reader may be reading is changed. A manifest counts once its ``_SUCCESS`` is there, so a
job that dies at any point leaves the whole old state, and two merges that start from one manifest can't both
commit: the second finds its number taken and raises. ``vacuum`` removes batches that no kept manifest names.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.schema import PARTITION_COLUMNS
from hourcast.session import path_exists
from hourcast.sources import lake

SCHEMA = "year int, month int, day int, batch string"


def _names(spark: SparkSession, folder: str) -> list[str]:
    if not path_exists(spark, folder):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return [f.getPath().getName() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests, whole or not, newest first."""
    return sorted((int(n) for n in _names(spark, f"{root}/manifests") if n.isdigit()), reverse=True)


def _path(root: str, number: int) -> str:
    return f"{root}/manifests/{number:012d}"


def newest(spark: SparkSession, root: str) -> int | None:
    """The newest whole manifest."""
    return next((n for n in _numbers(spark, root) if path_exists(spark, _path(root, n) + "/_SUCCESS")), None)


def days(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The days of a manifest (the newest whole one): a row for each."""
    number = newest(spark, root) if number is None else number
    return spark.createDataFrame([], SCHEMA) if number is None else spark.read.schema(SCHEMA).parquet(_path(root, number))


def read(spark: SparkSession, root: str, start: dt.date | str | None = None, end: dt.date | str | None = None,
         number: int | None = None) -> DataFrame:
    """The lake's rows with year, month and day, of days in [start, end]; only their folders are listed."""
    d = days(spark, root, number)
    day = F.make_date(*PARTITION_COLUMNS)
    if start is not None:
        d = d.where(day >= F.lit(str(start)).cast("date"))
    if end is not None:
        d = d.where(day <= F.lit(str(end)).cast("date"))
    rows = d.collect()  # one for each day
    if not rows:
        raise FileNotFoundError(f"no observations under {root}" + (f" between {start} and {end}" if start or end else ""))
    return _read(spark, root, rows)


def _read(spark: SparkSession, root: str, rows) -> DataFrame:
    paths = [f"{root}/data/batch={r['batch']}/year={r['year']}/month={r['month']}/day={r['day']}" for r in rows]
    return spark.read.option("basePath", f"{root}/data").option("mergeSchema", "true").parquet(*paths).drop("batch")


def merge(spark: SparkSession, new: DataFrame, root: str, keys=("StationID",), time_col: str = "ObservationTime",
          arrival: str | None = None) -> int:
    """Merge ``new`` into the lake, one row per (keys, time), new rows beating old ones; returns the number of touched days."""
    base = newest(spark, root)
    b, touched = lake.with_days(new, time_col)
    if not touched:
        return 0
    state = [] if base is None else days(spark, root, base).collect()
    number = lambda r: r["year"] * 10000 + r["month"] * 100 + r["day"]
    there = [r for r in state if number(r) in set(touched)]
    merged = lake.newest_rows(_read(spark, root, there) if there else None, b, list(keys), time_col, arrival)
    batch = "b" + uuid.uuid4().hex
    lake.write_days(merged, f"{root}/data/batch={batch}", time_col, mode="errorifexists")
    rows = [(r["year"], r["month"], r["day"], r["batch"]) for r in state if number(r) not in set(touched)]
    rows += [(d // 10000, d // 100 % 100, d % 100, batch) for d in touched]
    commit(spark, root, base, rows)
    return len(touched)


def commit(spark: SparkSession, root: str, base: int | None, rows: list[tuple]) -> int:
    """Write the manifest that follows ``base``. One whose write was cut short is written over; a whole one is not."""
    number = (base or 0) + 1
    path = _path(root, number)
    if path_exists(spark, path + "/_SUCCESS"):
        raise RuntimeError(f"manifest {number} of {root} is there already: another merge has committed since")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return number


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove batches that none of the ``keep`` newest whole manifests names, and older manifests; returns the batches.

    Run it while no merge is running.
    """
    whole = [n for n in _numbers(spark, root) if path_exists(spark, _path(root, n) + "/_SUCCESS")]
    used = {r["batch"] for n in whole[:keep] for r in days(spark, root, n).select("batch").distinct().collect()}
    gone = [n for n in _names(spark, f"{root}/data") if n.startswith("batch=") and n.removeprefix("batch=") not in used]
    for path in [f"{root}/data/{n}" for n in gone] + [_path(root, n) for n in whole[keep:]]:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return [n.removeprefix("batch=") for n in gone]


def incremental_load(spark: SparkSession, source: DataFrame, root: str, keys=("StationID",), time_col: str = "ObservationTime",
                     overlap_hours: int = 0) -> int:
    """S9 on this lake: everything at first, then the rows after the newest observation time less the overlap."""
    if newest(spark, root) is None:
        return merge(spark, source, root, keys, time_col)
    last = days(spark, root).select(F.max(F.make_date(*PARTITION_COLUMNS))).first()[0]
    mark = read(spark, root, last, last).agg(F.max(time_col)).first()[0] - dt.timedelta(hours=overlap_hours)
    return merge(spark, source.where(F.col(time_col) > lake.ntz_literal(mark)), root, keys, time_col)
