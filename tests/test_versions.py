"""Versioned mart tables: what readers see while, after and in spite of writes."""

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom import versions as v
from martloom.sources import storage
from martloom.versions import (
    expire,
    find_version,
    publish_versions,
    read_version,
    versions,
    write_version,
)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def numbers(spark, base, name="t"):
    return [x.number for x in versions(spark, base, name)]


def test_versions_are_read_by_number(spark, base, rows):
    for n in (3, 5, 0):
        write_version(spark.range(n).withColumn("state", F.lit(n)), base, "t")
    assert numbers(spark, base) == [1, 2, 3]
    assert [x.rows for x in versions(spark, base, "t")] == [3, 5, 0]
    assert read_version(spark, base, "t").count() == 0
    assert rows(read_version(spark, base, "t", 1)) == [(i, 3) for i in range(3)]
    assert read_version(spark, base, "t", -1).count() == 5
    assert read_version(spark, base, "t").dtypes == [("id", "bigint"), ("state", "int")]
    for missing in (4, -3):
        with pytest.raises(LookupError):
            read_version(spark, base, "t", missing)
    with pytest.raises(LookupError):
        find_version(spark, base, "none")


def test_a_failed_write_leaves_the_old_version_readable(spark, base):
    write_version(spark.range(4), base, "t")
    pinned = read_version(spark, base, "t")
    broken = spark.range(1000).repartition(4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        write_version(broken.toDF("id"), base, "t")
    assert numbers(spark, base) == [1]
    assert pinned.count() == read_version(spark, base, "t").count() == 4
    assert [c for c in storage.children(spark, f"{base}/t") if c.startswith(v.DATA)] == [find_version(spark, base, "t").folder.rsplit("/")[-1]]


def test_pinned_frames_do_not_change(spark, base):
    write_version(spark.range(4), base, "t")
    pinned = read_version(spark, base, "t")
    write_version(spark.range(9), base, "t")
    assert pinned.count() == 4
    assert read_version(spark, base, "t").count() == 9


def test_two_writers_get_two_numbers(spark, base, monkeypatch):
    """A writer whose number was taken meanwhile takes the next."""
    write_version(spark.range(1), base, "t")
    seen = v._numbers
    monkeypatch.setattr(v, "_numbers", lambda *a: [])
    assert write_version(spark.range(2), base, "t").number == 2
    monkeypatch.setattr(v, "_numbers", seen)
    assert numbers(spark, base) == [1, 2]


def test_a_torn_log_file_does_not_count(spark, base):
    write_version(spark.range(3), base, "t")
    Path(base, "t", v.LOG, "0000000002.json").write_text('{"number": 2, "fol')
    assert read_version(spark, base, "t").count() == 3
    assert write_version(spark.range(6), base, "t").number == 3
    assert read_version(spark, base, "t", -1).count() == 3


def test_partitions_and_measures(spark, base, rows):
    frame = spark.sql("SELECT id, CAST(id % 3 AS INT) AS part, CAST(id AS DECIMAL(10,2)) AS amount FROM range(9)")
    write_version(frame.select("part", "id", "amount"), base, "t", partition_by=["part"])
    read = read_version(spark, base, "t")
    assert read.dtypes == [("part", "int"), ("id", "bigint"), ("amount", "double")]
    assert rows(read.where("part = 1")) == [(1, 1, 1.0), (1, 4, 4.0), (1, 7, 7.0)]


def test_expire_keeps_the_last_and_removes_failed_writes(spark, base):
    for n in range(1, 5):
        write_version(spark.range(n), base, "t")
    spark.range(5).write.parquet(f"{base}/t/{v.DATA}abandoned")
    assert expire(spark, base, "t", keep=2) == [1, 2]
    assert storage.exists(spark, f"{base}/t/{v.DATA}abandoned")
    assert expire(spark, base, "t", keep=2, failed_after=timedelta(0)) == []
    assert not storage.exists(spark, f"{base}/t/{v.DATA}abandoned")
    assert numbers(spark, base) == [3, 4]
    assert read_version(spark, base, "t", 3).count() == 3
    assert write_version(spark.range(7), base, "t").number == 5
    with pytest.raises(ValueError):
        expire(spark, base, "t", keep=0)


def test_published_views_and_tables(spark, base):
    for n in (2, 3):
        write_version(spark.range(n), base, "versioned")
    assert publish_versions(spark, base, ["versioned"], number=-1) == ["versioned_table"]
    assert spark.sql("SELECT count(*) FROM versioned_table").first()[0] == 2
    spark.catalog.dropTempView("versioned_table")
    try:
        for number, expected in ((1, 2), (2, 3)):
            publish_versions(spark, base, ["versioned"], number, as_tables=True)
            assert spark.table("versioned_table").count() == expected
        write_version(spark.range(4).withColumn("more", F.lit("x")), base, "versioned")
        publish_versions(spark, base, ["versioned"], as_tables=True)
        assert spark.table("versioned_table").columns == ["id", "more"]
        assert spark.table("versioned_table").count() == 4
        with pytest.raises(LookupError):
            publish_versions(spark, base, ["versioned", "absent"], as_tables=True)
        assert spark.table("versioned_table").count() == 4
    finally:
        spark.sql("DROP TABLE IF EXISTS versioned_table")
    assert read_version(spark, base, "versioned").count() == 4
