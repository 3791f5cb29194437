"""A table is replaced by verified rows only."""

import pytest
from pyspark.sql import functions as F

from ebbtide.sources import versions as V


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def rows(spark, n, tag="a"):
    return spark.range(n).select("id", F.lit(tag).alias("tag"))


def test_replacements_follow_each_other(spark, path):
    assert V.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        V.read_current(spark, path)
    assert V.replace_verified(rows(spark, 10), path, 10) == 10
    held = V.read_current(spark, path)
    assert V.replace_verified(rows(spark, 20, "b"), path) == 20
    assert V.read_current(spark, path).filter("tag = 'b'").count() == 20
    assert held.count() == 10  # a reader of the version before


@pytest.mark.parametrize("n", [0, 9, 11])
def test_a_wrong_count_leaves_the_table(spark, path, n):
    V.replace_verified(rows(spark, 5), path)
    with pytest.raises(RuntimeError, match="not replaced"):
        V.replace_verified(rows(spark, n, "b"), path, 10)
    assert {tuple(r) for r in V.read_current(spark, path).collect()} == {(i, "a") for i in range(5)}


def test_a_broken_write_leaves_the_table(spark, path, tmp_path):
    V.replace_verified(rows(spark, 5), path)
    bad = rows(spark, 50).withColumn("tag", F.when(F.col("id") == 40, F.raise_error(F.lit("lost"))).otherwise("b"))
    with pytest.raises(Exception, match="lost"):
        V.replace_verified(bad, path)
    assert V.read_current(spark, path).count() == 5
    assert len([p for p in (tmp_path / "table").iterdir() if p.is_dir()]) == 1


def test_files_that_get_lost_are_noticed(spark, path, monkeypatch):
    V.replace_verified(rows(spark, 5), path)

    def loses(df, target, **options):
        return df.limit(3).write.parquet(target)

    monkeypatch.setattr(V, "write_parquet", loses)
    with pytest.raises(RuntimeError):
        V.replace_verified(rows(spark, 8), path, 8)
    assert V.read_current(spark, path).count() == 5


def test_old_versions_go(spark, path, tmp_path):
    for n in range(1, 6):
        V.replace_verified(rows(spark, n), path, keep=2)
    assert len([p for p in (tmp_path / "table").iterdir() if p.is_dir()]) == 3
    V.replace_verified(rows(spark, 9), path, keep=0)
    assert len([p for p in (tmp_path / "table").iterdir() if p.is_dir()]) == 1
    assert V.read_current(spark, path).count() == 9


def test_a_table_may_read_itself_and_be_partitioned(spark, path):
    V.replace_verified(rows(spark, 6), path, partition_by=["tag"])
    doubled = V.read_current(spark, path).withColumn("id", F.col("id") * 2)
    assert V.replace_verified(doubled, path, 6, partition_by=["tag"]) == 6
    assert {r["id"] for r in V.read_current(spark, path).collect()} == {0, 2, 4, 6, 8, 10}


def test_no_rows(spark, path):
    assert V.replace_verified(rows(spark, 0), path, 0) == 0
    assert V.read_current(spark, path).count() == 0
