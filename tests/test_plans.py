"""Plan-shape checks: rank / position work never collapses into a single partition, scans prune."""

import re

import pytest

import __spark_entry__ as ent
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_inputs(plan: str) -> list[str]:
    """The operator right below each ``Exchange SinglePartition``."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            out.append(lines[i + 1] if i + 1 < len(lines) else "")
    return out


@pytest.mark.parametrize("name", ["avg_rank", "spearman", "series_position", "time_split", "describe", "kruskal",
                                  "windows", "backfill"])
def test_no_single_partition_exchange_over_data(spark, name):
    """Row-level work never funnels into one partition. Allowed single-partition exchanges: over a
    map-side partial global aggregate (one row per task), or over the bucket-totals table of the
    rank helper (<= 64 rows per key, the ``_bk`` aggregate) when the key is a constant."""
    plan = _plan(ent.queries()[name](spark, SF_SMALL))
    for below in _single_partition_inputs(plan):
        partial_global = "HashAggregate(keys=[], functions=[partial_" in below
        bucket_table = "_bk" in below and "HashAggregate" in below
        assert partial_global or bucket_table, (name, below)


def test_lookback_uses_partition_filters(spark):
    plan = _plan(ent.queries()["lookback_scan"](spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[[^\]]+\]", plan)


def test_column_pruning_on_wide_scan(spark):
    plan = _plan(ent.queries()["clamp_negative"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double,c_mktsegment:string>" in plan


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0 and "band" in df.columns


def test_every_query_has_oracle_or_note():
    from hourcast.plans import catalog
    q, o, n = catalog.queries(), catalog.oracle_sql(), catalog.notes()
    assert set(q) == set(o) | set(n)


def test_no_row_exchange_on_the_series_key_alone(spark):
    """Positions, lengths and splits spread a series over its days: a plan's row exchanges hash on more than the key."""
    import re

    from hourcast.operators import models, split
    from hourcast.plans import adapters as ad
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        h = ad.obs_hourly(spark, SF_SMALL).select("StationID", "ObservationTime", "Temperature")
        for df in (split.holdout_split(h, ["StationID"], "ObservationTime"), split.recent_weeks(h, ["StationID"], "ObservationTime"),
                   models.last_anchor(h, ["StationID"], "ObservationTime", "Temperature")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            for line in plan.split("\n"):
                if re.search(r"Exchange hashpartitioning\(StationID#\d+L?, \d+\)", line):
                    below = plan[plan.index(line):].split("\n")[1]
                    assert "HashAggregate" in below, line  # the (series, bucket) counts only
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lag_plan_does_not_grow_with_the_lags(spark):
    from hourcast.operators import models
    from hourcast.plans import adapters as ad
    h = ad.obs_hourly(spark, SF_SMALL).select("StationID", "ObservationTime", "Temperature")
    scans = [models.anchor_features(h, ["StationID"], "ObservationTime", "Temperature", lags)._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
             for lags in ((0, 1), (0, 1, 2, 23))]
    assert scans[0] == scans[1] <= 3


def test_ordinal_with_hour_buckets(spark):
    import datetime as dt

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from hourcast.operators.series import ordinal
    t0 = dt.datetime(2024, 1, 1)
    rows = [("A", t0 + dt.timedelta(minutes=7 * i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int")
    got = ordinal(df, ["k"], "t", bucket=F.date_trunc("hour", "t"))
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t")))
    assert got.join(ref, ["k", "t"]).filter(F.col("pos") != F.col("rn")).count() == 0


def test_wide_rows_are_dealt_out_by_their_number(spark, tmp_path):
    """A file of few splits but many rows: tasks by rows, not by bytes."""
    from hourcast.plans import adapters as ad
    spark.range(0, ad.WIDE_ROWS_PER_TASK * 6, 1, 1).write.parquet(str(tmp_path / "t.parquet"))
    df = spark.read.parquet(str(tmp_path / "t.parquet"))
    spread = ad._spread(df)
    assert spread.rdd.getNumPartitions() >= 6 and spread.count() == df.count()
