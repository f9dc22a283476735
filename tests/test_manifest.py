"""All-or-nothing merges: a job that dies leaves a whole old state."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourcast.sources import manifest as mf

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "StationID string, ObservationTime timestamp_ntz, Temperature double"


def day(spark, d, hours, value):
    return spark.createDataFrame([("A", T0 + dt.timedelta(days=d, hours=h), value) for h in hours], SCHEMA)


def state(spark, root, **kw):
    return sorted((r.day, r.ObservationTime.hour, r.Temperature) for r in mf.read(spark, root, **kw).collect())


def test_merge_keeps_the_day_and_takes_the_newer_rows(spark, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(FileNotFoundError):
        mf.read(spark, root)
    assert mf.merge(spark, day(spark, 0, range(6), 1.0).unionByName(day(spark, 1, range(3), 1.0)), root) == 2
    assert mf.merge(spark, day(spark, 1, range(2, 5), 2.0), root) == 1
    assert state(spark, root) == [(1, h, 1.0) for h in range(6)] + [(2, 0, 1.0), (2, 1, 1.0), (2, 2, 2.0), (2, 3, 2.0), (2, 4, 2.0)]
    assert mf.merge(spark, day(spark, 0, [], 1.0), root) == 0 and mf.newest(spark, root) == 2
    assert state(spark, root, start="2024-01-02") == state(spark, root)[6:]
    assert state(spark, root, number=1) == [(1, h, 1.0) for h in range(6)] + [(2, h, 1.0) for h in range(3)]  # the state before
    with pytest.raises(FileNotFoundError):
        mf.read(spark, root, start="2025-01-01")


@pytest.mark.parametrize("moment", ["between two days", "before the manifest", "within the manifest"])
def test_a_job_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch, moment):
    root = str(tmp_path / "lake")
    mf.merge(spark, day(spark, 0, range(6), 1.0).unionByName(day(spark, 1, range(6), 1.0)), root)
    before = state(spark, root)
    new = day(spark, 0, range(6), 2.0).unionByName(day(spark, 1, range(6), 2.0))
    with monkeypatch.context() as m:
        if moment == "between two days":
            write = mf.lake.write_days

            def half(df, path, *a, **kw):
                write(df.where("day = 1"), path, *a, **kw)
                raise RuntimeError("lost")

            m.setattr(mf.lake, "write_days", half)
        elif moment == "before the manifest":
            m.setattr(mf, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        else:
            def torn(spark, root, base, rows):
                path = mf._path(root, base + 1)
                spark.createDataFrame(rows[:1], mf.SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
                raise RuntimeError("lost")

            m.setattr(mf, "commit", torn)
        with pytest.raises(RuntimeError):
            mf.merge(spark, new, root)
    assert state(spark, root) == before
    assert mf.merge(spark, new, root) == 2
    assert state(spark, root) == [(d, h, 2.0) for d, h, _ in before]
    assert len(mf.vacuum(spark, root, keep=1)) in (1, 2)
    assert state(spark, root) == [(d, h, 2.0) for d, h, _ in before]


def test_second_of_two_merges_raises(spark, tmp_path):
    root = str(tmp_path / "lake")
    mf.merge(spark, day(spark, 0, range(2), 1.0), root)
    rows = [(r.year, r.month, r.day, r.batch) for r in mf.days(spark, root).collect()]
    mf.commit(spark, root, 1, rows)
    with pytest.raises(RuntimeError):
        mf.commit(spark, root, 1, rows)
    assert mf.newest(spark, root) == 2


def test_incremental_load(spark, tmp_path):
    root = str(tmp_path / "lake")
    source = day(spark, 0, range(24), 1.0).unionByName(day(spark, 1, range(24), 1.0))
    assert mf.incremental_load(spark, source.where(F.col("ObservationTime") < F.lit("2024-01-02 05:00:00").cast("timestamp_ntz")), root) == 2
    assert mf.incremental_load(spark, source, root, overlap_hours=2) == 1
    assert mf.read(spark, root).count() == 48 and mf.incremental_load(spark, source, root) == 0
