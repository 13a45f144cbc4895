"""The history of a table against the snapshots it was made of."""

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom import versions as v
from martloom.sources import history

DAYS = [date(2001, 1, d) for d in (3, 4, 10, 20)]


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def random_states(seed):
    """Rows that stay, go, come, come back, repeat and change, with nulls and empty text."""
    rng = random.Random(seed)
    pool = [(k if k % 5 else None, rng.choice(["a", "", None, "b"]), None if k % 7 == 0 else k * 1.25, DAYS[k % 3]) for k in range(60)]
    return [[r for r in pool for _ in range(rng.choice([0, 0, 1, 1, 1, 2]))] for _ in DAYS]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_day_reads_as_its_last_snapshot(spark, tmp_path, seed):
    base, states = str(tmp_path), random_states(seed)
    frames = [
        spark.createDataFrame(s, "k long, name string, price double, day date")
        .withColumn("price", F.col("price").cast("decimal(8,2)"))
        .repartition(3)
        for s in states
    ]
    for day, frame in zip(DAYS, frames, strict=True):
        history.record(frame, base, "t", day)
    assert history.days(spark, base, "t") == DAYS
    for day, at in ((DAYS[0], 0), (DAYS[1], 1), (date(2001, 1, 9), 1), (DAYS[2], 2), (DAYS[3], 3), (date(2030, 1, 1), 3)):
        read = history.as_of(spark, base, "t", day)
        assert read.dtypes == frames[at].dtypes
        assert rows_of(read) == rows_of(frames[at])
    with pytest.raises(LookupError):
        history.as_of(spark, base, "t", date(2001, 1, 2))


def test_intervals(spark, tmp_path):
    base = str(tmp_path)
    states = [[(1, "stays"), (2, "goes")], [(1, "stays"), (3, "comes")], [(1, "stays"), (2, "goes"), (3, "comes"), (3, "comes")]]
    for day, state in zip(DAYS, states, strict=False):
        history.record(spark.createDataFrame(state, "k long, name string"), base, "t", day)
    found = sorted((tuple(r) for r in history.intervals(spark, base, "t").collect()), key=str)
    a, b, c = DAYS[:3]
    assert found == sorted(
        [(1, "stays", 1, a, None), (2, "goes", 1, a, b), (2, "goes", 1, c, None), (3, "comes", 1, b, c), (3, "comes", 2, c, None)],
        key=str,
    )


def test_only_changes_are_written(spark, tmp_path):
    base = str(tmp_path)
    first = spark.range(1000).withColumn("x", F.col("id") * 2)
    history.record(first, base, "t", DAYS[0])
    same = history.record(first.repartition(5), base, "t", DAYS[1])
    changed = history.record(first.withColumn("x", F.when(F.col("id") == 7, 0).otherwise(F.col("x"))), base, "t", DAYS[2])
    assert same.rows == 0 and changed.rows == 2
    empty = history.record(first.limit(0), base, "t", DAYS[3])
    assert empty.rows == 1000 and history.as_of(spark, base, "t", DAYS[3]).count() == 0
    assert history.as_of(spark, base, "t", DAYS[2]).where("x = 0").count() == 2


def test_contents_are_told_apart(spark, tmp_path):
    base = str(tmp_path)
    for day, row in zip(DAYS, [("a", None), (None, "a"), ("", "a"), ("a", "")], strict=True):
        assert history.record(spark.createDataFrame([row], "x string, y string"), base, "t", day).rows == (1 if day == DAYS[0] else 2)
        assert rows_of(history.as_of(spark, base, "t", day)) == Counter([row])


def test_wrong_days_columns_and_failures_leave_the_history(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    frame = spark.createDataFrame([(1, "a")], "k long, name string")
    history.record(frame, base, "t", DAYS[1])
    for day in DAYS[:2]:
        with pytest.raises(ValueError, match="reaches to"):
            history.record(frame, base, "t", day)
    with pytest.raises(ValueError, match="other columns"):
        history.record(frame.withColumn("more", F.lit(1)), base, "t", DAYS[2])
    with pytest.raises(ValueError, match="taken"):
        history.record(frame.withColumnRenamed("k", "_id"), base, "u", DAYS[2])
    broken = frame.withColumn("k", F.when(F.col("k") == 1, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="no"):
        history.record(broken, base, "t", DAYS[2])
    assert history.days(spark, base, "t") == [DAYS[1]]
    assert rows_of(history.as_of(spark, base, "t", DAYS[3])) == Counter([(1, "a")])
    assert len(v.versions(spark, base, "t")) == 1
