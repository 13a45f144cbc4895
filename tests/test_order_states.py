"""Distinct orders from states of single days, against counting them at once."""

import random

import pytest
from pyspark.sql import functions as F

from martloom.operators.calendar import week_calendar
from martloom.operators.customers import customer_activity
from martloom.operators.order_states import _bits, distinct_orders, merged_activity, order_states
from martloom.operators.sales import incremental_sales, sales_with_date
from martloom.plans.refresh import dated_order_states, read_daily, refresh_daily
from martloom.plans.shared import materialize

SALES = (
    "sold_date_sk long, customer_sk long, order_number long, sold_date date, daily_sales_amt decimal(12,2), "
    "daily_net_profit decimal(12,2)"
)


def as_dict(activity):
    return {r.customer_sk: tuple(r)[1:] for r in activity.collect()}


@pytest.fixture(scope="module")
def lines(spark):
    """Customers with few and very many orders, orders on several days, nulls everywhere, numbers at bucket ends."""
    rng = random.Random(3)
    numbers = [None, 0, 1, 32767, 32768, 32769, 65536, -1, -32768, 3_000_000_000, 3_000_000_001]
    rows = [(d, c, n, None, None, None) for d in (1, 2, None) for c in (1, 2, None) for n in rng.sample(numbers, 7)]
    rows += [(rng.choice([1, 2, 3]), 5, 40_000 + rng.randrange(3000), None, None, None) for _ in range(6000)]
    rows += [(4, 6, n, None, None, None) for n in range(100_000, 100_040)]
    frame = spark.createDataFrame(rows, SALES)
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("sold_date_sk").cast("int"))
    return materialize(
        frame.withColumns(
            {
                "sold_date": F.when(F.col("sold_date_sk") != 2, day),
                "daily_sales_amt": (F.coalesce("order_number", F.lit(7)) % 100 / 4).cast("decimal(12,2)"),
            }
        ),
        "order_lines",
    )


@pytest.mark.parametrize("dense_from", [1, 30, 1024, 40_000])
def test_states_of_days_merge_exactly(lines, dense_from):
    whole = as_dict(customer_activity(lines))
    together = order_states(lines, dense_from)
    assert as_dict(merged_activity(together)) == whole
    days = [order_states(lines.where(F.coalesce("sold_date_sk", F.lit(0)) == d), dense_from) for d in range(5)]
    apart = days[0]
    for more in days[1:]:
        apart = apart.unionByName(more)
    assert as_dict(merged_activity(materialize(apart, "states"))) == whole
    some = lines.where("sold_date_sk IN (1, 3)")
    assert as_dict(merged_activity(days[1].unionByName(days[3]))) == as_dict(customer_activity(some))


def test_many_orders_are_bits(lines):
    rows = order_states(lines, 500).collect()
    dense = [r for r in rows if r.bitmap is not None]
    assert dense and {r.customer_sk for r in dense} == {5} and all(not r.places and len(r.bitmap) == 4096 for r in dense)
    assert all(len(r.places) < 500 for r in rows)
    assert len({(r.sold_date_sk, r.customer_sk, r.bucket) for r in rows}) == len(rows)


def test_sets_with_and_without_bits_unite(lines):
    """A bucket may be dense on one day and sparse on another."""
    mixed = order_states(lines.where("sold_date_sk = 1"), 1).unionByName(order_states(lines.where("sold_date_sk <> 1"), 10**6))
    counts = distinct_orders(mixed).groupBy("customer_sk").agg(F.sum("orders").alias("n"))
    expected = lines.where("sold_date_sk IS NOT NULL").groupBy("customer_sk").agg(F.count_distinct("order_number").alias("n"))
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in expected.where("n > 0").collect()}


def test_nothing(lines):
    assert merged_activity(order_states(lines.limit(0))).count() == 0


def test_refreshed_states(spark, tables, tmp_path):
    sold = materialize(incremental_sales(tables.catalog_sales, tables.web_sales, tables.store_sales), "state_lines")
    days = materialize(week_calendar(tables.date_dim), "state_days")
    base = str(tmp_path)
    for state in (sold.where("item_sk % 3 <> 0 OR sold_date_sk % 5 = 1"), sold):
        refresh_daily(state, days, base, "states", dated_order_states, partition_days=256)
        merged = merged_activity(read_daily(spark, base, "states"))
        assert as_dict(merged) == as_dict(customer_activity(sales_with_date(state, days)))


def test_states_are_built_from_one_pass(lines):
    """Bits come from the places of their row: sums, sets and bits take one reading and one shuffle, without a join."""
    plan = order_states(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("places", [[0], [7, 8], [32767], list(range(0, 32768, 31)), list(range(32768))])
def test_bits_lie_as_spark_lays_them(spark, places):
    frame = spark.createDataFrame([(p,) for p in places], "place int")
    made, found = frame.agg(_bits(F.array_sort(F.collect_list("place"))), F.bitmap_construct_agg("place")).first()
    assert made == found
