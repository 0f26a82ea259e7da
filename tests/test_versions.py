"""Versioned tables: one step from the old content to the new one."""

import pytest
from pyspark.sql import functions as F

from goldenrec.plans import versions
from helpers import FAILED_QUERY


def numbers(frame):
    return sorted(r[0] for r in frame.collect())


def data_folders(root):
    return sorted(p.name for p in root.iterdir() if p.name.startswith("v"))


def test_replace_and_read(spark, tmp_path):
    root = tmp_path / "t.parquet"
    assert versions.current(spark, str(root)) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(root))
    for size in (3, 5, 2, 4):
        assert numbers(versions.replace(spark.range(size), f"{root}/")) == list(range(size))
        assert numbers(versions.read(spark, str(root))) == list(range(size))
    assert versions.current(spark, str(root)).number == 4
    # the current version and the one before it
    assert len(data_folders(root)) == 2
    assert sorted(p.name for p in (root / "_versions").glob("*.json")) == ["000000000003.json", "000000000004.json"]


def test_a_write_that_fails_half_way_leaves_the_old_table(spark, tmp_path):
    root = tmp_path / "t"
    versions.replace(spark.range(10), str(root))
    early = versions.read(spark, str(root))
    late = F.when(F.col("id") == 900, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id"))
    with pytest.raises(FAILED_QUERY):
        versions.replace(spark.range(0, 1000, 1, 4).select(late.alias("id")), str(root))
    assert numbers(versions.read(spark, str(root))) == list(range(10))
    assert len(data_folders(root)) == 2
    # what the failed one left goes with the next; a reader of the old version can finish
    versions.replace(spark.range(4), str(root))
    assert numbers(early) == list(range(10))
    assert numbers(versions.read(spark, str(root))) == list(range(4))
    assert len(data_folders(root)) == 2


def test_only_one_of_two_writers_commits(spark, tmp_path):
    root = str(tmp_path / "t")
    first = versions.commit(spark, root, {"table": ["v1-a"]}, {"by": "me"})
    versions.commit(spark, root, {"table": ["v2-a"]}, after=first.number)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, root, {"table": ["v2-b"]}, after=first.number)
    assert versions.current(spark, root) == versions.Version(2, {"table": ["v2-a"]}, {})


def test_folders_of_a_writer_at_work_stay(spark, tmp_path):
    root = tmp_path / "t"
    versions.replace(spark.range(1), str(root))
    at_work = versions.new_folder(versions.current(spark, str(root)))
    spark.range(2).write.parquet(f"{root}/{at_work}")
    versions.clean(spark, str(root))
    assert at_work in data_folders(root)
