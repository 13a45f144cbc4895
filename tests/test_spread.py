"""Shuffles of large tables: as many tasks as the input files ask for, whatever the session's number is."""

import re

import pytest

from checks.queries import Frames, queries
from martloom.functions import spread
from martloom.functions.spread import dealt, tasks_for, wanted_tasks
from martloom.operators import sales
from tests.conftest import SMALL


def shuffles(df):
    """Shuffle keys and numbers of partitions."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\)", plan)


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(spread, "BYTES_A_TASK", 2_000)


def same(one, other):
    return one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_tasks_follow_the_files(spark, tmp_path, monkeypatch):
    spark.range(10_000).repartition(3).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in tmp_path.glob("t/*.parquet"))
    assert tasks_for(stored) == tasks_for(spark.range(5)) == 1 and wanted_tasks(stored) is None
    monkeypatch.setattr(spread, "BYTES_A_TASK", size // 20)
    assert tasks_for(stored.where("id > 5")) in (20, 21) and wanted_tasks(stored) in (20, 21)
    assert dealt(stored, ["id"], None) is stored
    monkeypatch.setattr(spread, "BYTES_A_TASK", size // 8 + 1)
    assert wanted_tasks(stored) is None


@pytest.mark.parametrize("name", ["customer_cohorts", "customer_rfm"])
def test_large_tables_meet_in_as_many_tasks_as_they_ask_for(spark, small_tasks, monkeypatch, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        query = queries()[name](spark, SMALL)
        found = [int(n) for keys, n in shuffles(query) if re.match(r"[lop]_(order|part)key", keys)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # orders and parts with the lines of three channels
    assert len(found) >= 6 and min(found) > 8
    monkeypatch.undo()
    assert same(query, queries()[name](spark, SMALL))


@pytest.mark.parametrize("name", ["fact_sales_daily", "published_sql", "published_version"])
def test_a_large_daily_fact_is_summed_in_as_many_tasks_as_it_asks_for(spark, small_tasks, monkeypatch, name):
    frames = Frames(spark, SMALL)
    fact = sales.fact_sales_daily(frames.incremental_sales, frames.calendar)
    (tasks,) = {int(n) for keys, n in shuffles(fact) if keys.startswith("customer_sk")}
    assert tasks > 8
    query = queries()[name](spark, SMALL)
    monkeypatch.undo()
    assert same(query, queries()[name](spark, SMALL))
