"""Day-partitioned observation lake.

Layout ``root/year=YYYY/month=M/day=D/part-*.parquet``; partition columns live in the path only.
Scans are one ``spark.read.parquet(root)`` with predicates on the partition columns, which Catalyst
turns into ``PartitionFilters`` (directories outside the range are never listed for reading).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from hourcast import session
from hourcast.functions import timefeat as tf
from hourcast.schema import PARTITION_COLUMNS
from hourcast.session import path_exists

EPOCH_MARK = dt.datetime(2000, 1, 1)


def ntz_literal(value: dt.datetime) -> Column:
    """A wall-clock literal that no session or OS time zone can shift (parsed from text)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _day_of(df_cols=("year", "month", "day")) -> Column:
    y, m, d = df_cols
    return F.make_date(F.col(y), F.col(m), F.col(d))


def write_days(df: DataFrame, root: str, time_col: str = "ObservationTime", mode: str = "dynamic",
               files_per_day: int | None = None, rows_per_file: int = 2_000_000) -> None:
    """S3 / A2: write one folder per day; only the days present in ``df`` are replaced.

    A day gets ``ceil(rows / rows_per_file)`` files (or ``files_per_day``), whatever number of tasks
    holds its rows: rows are exchanged by (day, salt), so neither thousands of fragments nor one
    task for a heavy day come out. The row counts are one small row per day.
    """
    out = df
    for k, v in tf.time_parts(time_col).items():
        if k in PARTITION_COLUMNS and k not in out.columns:
            out = out.withColumn(k, v)
    if files_per_day is None:
        days = out.groupBy(*PARTITION_COLUMNS).agg(
            F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_per_file)).alias("_files"))
        out = out.join(F.broadcast(days), PARTITION_COLUMNS)  # one row per day
    else:
        out = out.withColumn("_files", F.lit(files_per_day))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_files"))
    out = out.withColumn("_salt", salt).repartition(*PARTITION_COLUMNS, "_salt").drop("_salt", "_files")
    w = out.write.partitionBy(*PARTITION_COLUMNS)
    if mode == "dynamic":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    w.parquet(root)


def has_data(spark: SparkSession, root: str) -> bool:
    """Does the lake hold at least one row? A missing or empty root is 'no data'; errors propagate."""
    return path_exists(spark, root) and bool(_days(spark, root))


def _days(spark: SparkSession, root: str, among: list[int] | None = None) -> list[int]:
    """Day folders of the lake as yyyymmdd numbers (of ``among`` only), newest first."""
    try:
        df = spark.read.parquet(root)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # the folder has no data file yet
            return []
        raise
    days = df.select(_day_number().alias("d"))
    if among is not None:
        days = days.where(F.col("d").isin(among))
    return sorted((r["d"] for r in days.distinct().collect()), reverse=True)


def _day_number() -> Column:
    return F.col("year") * 10000 + F.col("month") * 100 + F.col("day")


def scan(spark: SparkSession, root: str, start: dt.date | str | None = None,
         end: dt.date | str | None = None, ignore_corrupt: bool = False) -> DataFrame:
    """Scan days in [start, end] (either bound optional) with partition pruning."""
    r = spark.read
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    df = r.parquet(root)
    day = _day_of()
    if start is not None:
        df = df.filter(day >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(day <= F.lit(str(end)).cast("date"))
    return df


def scan_lookback(spark: SparkSession, root: str, as_of: dt.date | str, days: int = 30) -> DataFrame:
    """Daily partitions in [as_of - days, as_of]; raises when nothing is there."""
    end = dt.date.fromisoformat(str(as_of)[:10])
    df = scan(spark, root, end - dt.timedelta(days=days), end)
    if df.isEmpty():
        raise FileNotFoundError(f"no observations between {end - dt.timedelta(days=days)} and {end}")
    return df


def scan_months(spark: SparkSession, root: str, as_of: dt.date | str, start_year: int | None = None) -> DataFrame:
    """Every month from January of ``start_year`` (default: year of as_of - 3*365 days) to as_of's month."""
    end = dt.date.fromisoformat(str(as_of)[:10])
    if start_year is None:
        start_year = (end - dt.timedelta(days=365 * 3)).year
    df = spark.read.parquet(root)
    ym = F.col("year") * 100 + F.col("month")
    return df.filter((ym >= start_year * 100 + 1) & (ym <= end.year * 100 + end.month))


def scan_recursive(spark: SparkSession, root: str, year: int | None = None, month: int | None = None,
                   latest_file_only: bool = False) -> DataFrame:
    """Optional year / month filter, unreadable files skipped; inference mode keeps the
    newest day: all files of its folder, however many tasks have written them."""
    df = spark.read.option("ignoreCorruptFiles", "true").parquet(root)
    if year is not None:
        df = df.filter(F.col("year") == year)
    if month is not None:
        df = df.filter(F.col("month") == month)
    if latest_file_only:
        # The newest day is chosen from folder names alone, then read with literal partition filters.
        last = df.select(F.max(F.struct(*PARTITION_COLUMNS)).alias("d")).first()["d"]
        if last is not None:
            for c in PARTITION_COLUMNS:
                df = df.filter(F.col(c) == F.lit(last[c]))
    return df


def latest_day(spark: SparkSession, root: str) -> dt.date | None:
    """Newest day folder (reads only partition values)."""
    days = _days(spark, root) if path_exists(spark, root) else []
    return dt.datetime.strptime(str(days[0]), "%Y%m%d").date() if days else None


def high_water_mark(spark: SparkSession, root: str, time_col: str = "ObservationTime") -> DataFrame:
    """One-row frame with the newest observation time in the newest day folder.

    An empty or missing lake gives 2000-01-01 00:00 (first load). Only that one day is scanned.
    """
    d = latest_day(spark, root)
    if d is None:
        return spark.range(1).select(ntz_literal(EPOCH_MARK).alias("high_water_mark"))
    day_df = scan(spark, root, d, d)
    return day_df.agg(F.coalesce(F.max(time_col), ntz_literal(EPOCH_MARK))
                      .alias("high_water_mark"))


def day_counts(df: DataFrame) -> DataFrame:
    """A2 check table: rows per day folder."""
    return df.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))


def merge_days(spark: SparkSession, new: DataFrame, root: str, keys=("StationID",),
               time_col: str = "ObservationTime", arrival: str | None = None) -> int:
    """Merge ``new`` rows into the lake; only the days they touch are rewritten.

    The touched days (one number per day) come to the driver and prune the existing rows' scan by
    literal partition filters. One row per (keys, time) is kept: a new delivery beats the lake, a
    later ``arrival`` beats an earlier one, and equal ones are told apart by their content, so the
    result does not depend on row order. Where days are already there, the merged rows are
    materialised in the shared checkpoint folder before the dynamic overwrite, because the job
    rewrites the very folders it read. Returns the number of touched days.

    (Fixes the source behaviour where a mid-day update replaced a whole day with the new hours.)
    """
    b, touched = with_days(new, time_col)
    if not touched:
        return 0
    there = _days(spark, root, touched) if path_exists(spark, root) else []
    existing = spark.read.parquet(root).filter(_day_number().isin(there)) if there else None
    merged = newest_rows(existing, b, keys, time_col, arrival)
    if there:
        merged = session.cut_lineage(merged)
    write_days(merged, root, time_col, mode="dynamic")
    return len(touched)


def with_days(new: DataFrame, time_col: str) -> tuple[DataFrame, list[int]]:
    """``new`` with its day columns, and the days it touches as yyyymmdd numbers."""
    b = new
    for k, v in tf.time_parts(time_col).items():
        if k in PARTITION_COLUMNS:
            b = b.withColumn(k, v)
    return b, [r["d"] for r in b.select(_day_number().alias("d")).distinct().collect()]


def newest_rows(existing: DataFrame | None, new: DataFrame, keys, time_col: str, arrival: str | None = None) -> DataFrame:
    """One row per (keys, time): a new one beats an existing one, a later ``arrival`` an earlier one, then the content decides."""
    own = [c for c in new.columns if c != arrival]
    combined = new.withColumn("_prio", F.lit(1))
    combined = combined.withColumn("_arrived", F.col(arrival).cast("timestamp") if arrival else F.lit(None).cast("timestamp"))
    if arrival:
        combined = combined.drop(arrival)
    if existing is not None:
        combined = existing.withColumn("_prio", F.lit(0)).unionByName(combined, allowMissingColumns=True)
    w = Window.partitionBy(*keys, time_col).orderBy(F.desc("_prio"), F.desc_nulls_last("_arrived"), F.xxhash64(*own))
    return combined.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_prio", "_arrived")


def incremental_load(spark: SparkSession, source: DataFrame, root: str, keys=("StationID",),
                     time_col: str = "ObservationTime", overlap_hours: int = 0) -> int:
    """Full load into an empty lake, else load rows after the high-water mark (minus an
    optional re-delivery overlap, made harmless by the merge). No-op when up to date."""
    if not has_data(spark, root):
        # first load: the same merge (one row per key and time) into an empty lake
        return merge_days(spark, source, root, keys, time_col)
    mark = high_water_mark(spark, root, time_col).first()["high_water_mark"]
    start = mark - dt.timedelta(hours=overlap_hours)
    fresh = source.filter(F.col(time_col) > ntz_literal(start if overlap_hours else mark))
    return merge_days(spark, fresh, root, keys, time_col)


def missing_hours(expected: DataFrame, lake_df: DataFrame, keys=("StationID",), time_col: str = "ObservationTime") -> DataFrame:
    """S2 (re-aimed): expected (keys, hour) rows absent from the lake: the gaps to request."""
    keys = list(keys)
    have = lake_df.select(*keys, hour_floor_col(time_col).alias(time_col)).distinct()
    return expected.join(have, keys + [time_col], "left_anti")


def hour_floor_col(time_col: str):
    return tf.hour_floor(time_col)


def request_ranges(spans: DataFrame, start_col: str = "start", end_col: str = "end", block_days: int = 30) -> DataFrame:
    """Cut each [start, end] into request blocks: s0 = start (to the hour), e_k = the day of
    min(s_k + block_days, end) at 23:00, s_{k+1} = e_k + 1 hour; texts in ``yyyyMMddHHmm``.

    Closed form: s_k = day(start) + (block_days + 1) * k days (k >= 1), so the blocks come from
    ``sequence`` + ``explode`` per span -- no loop.
    """
    s0 = tf.hour_floor(start_col)
    e_all = tf.hour_floor(end_col)
    k_max = F.floor(F.datediff(F.to_date(e_all), F.to_date(s0)) / F.lit(block_days + 1)) + 1
    x = spans.withColumns({"_s0": s0, "_e": e_all}).withColumn("k", F.explode(F.sequence(F.lit(0), k_max.cast("int"))))
    day0 = F.to_date("_s0")
    s_k = F.when(F.col("k") == 0, F.col("_s0")).otherwise(
        F.date_add(day0, (F.col("k") * (block_days + 1)).cast("int")).cast("timestamp_ntz"))
    x = x.withColumn("_sk", s_k).filter(F.col("_sk") <= F.col("_e"))
    e_k = F.least(F.col("_sk") + F.make_dt_interval(F.lit(block_days)), F.col("_e"))
    e_k = F.to_date(e_k).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(23))
    return x.withColumn("range_start", tf.format_obs_time("_sk")).withColumn("range_end", tf.format_obs_time(e_k)).drop(
        "_s0", "_e", "_sk")
