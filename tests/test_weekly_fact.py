"""The factored weekly fact against pairs written out one by one."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martloom.operators import sales
from martloom.operators.calendar import week_calendar

FIRST = date(2002, 12, 15)
DAYS = 60


@pytest.fixture(scope="module")
def calendar(spark):
    days = [(i, FIRST + timedelta(days=i)) for i in range(DAYS)]
    raw = spark.createDataFrame(
        [(k, d, d.year, d.month, d.day, "x", 1, "q") for k, d in days],
        "d_date_sk long, d_date date, d_year int, d_moy int, d_dom int, d_day_name string, d_qoy int, "
        "d_quarter_name string",
    )
    return week_calendar(raw).cache()


LINES = (
    "warehouse_sk long, item_sk long, sold_date_sk long, daily_qty {0}, daily_sales_amt {0}, daily_net_profit {0}"
)
STOCK = "inv_date_sk long, inv_item_sk long, inv_warehouse_sk long, inv_quantity_on_hand {0}"


def _week(key):
    day = FIRST + timedelta(days=key)
    number = (day - timedelta(days=1)).isocalendar().week
    return f"{day.year}{number:02d}", day - timedelta(days=day.isoweekday() % 7)


def _total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def paired(lines, stock):
    """The definition: daily sums, every pairing with a snapshot of the week, then sums."""
    daily = defaultdict(list)
    for warehouse, item, day, *measures in lines:
        if day < DAYS:
            daily[warehouse, item, day].append(measures)
    groups = defaultdict(list)
    for (warehouse, item, day), found in daily.items():
        sums = [_total(column) for column in zip(*found)]
        key, start = _week(day)
        for inv_day, inv_item, inv_warehouse, on_hand in stock:
            if inv_day < DAYS and (inv_item, inv_warehouse) == (item, warehouse) and _week(inv_day)[0] == key:
                groups[key, warehouse, item, start].append([*sums, on_hand])
    return {
        group: (*[_total(c) for c in list(zip(*found))[:3]], _total(list(zip(*found))[3]) or 0)
        for group, found in groups.items()
    }


def _computed(spark, calendar, lines, stock, kind="decimal(12,2)", **options):
    fact = sales.weekly_sales_inventory(
        spark.createDataFrame(lines, LINES.format(kind)),
        spark.createDataFrame(stock, STOCK.format(kind)),
        calendar,
        **options,
    )
    return {(r.yr_wk_num, r.warehouse_sk, r.item_sk, r.week_start_date): r for r in fact.collect()}


def _measures(row):
    return row.sum_qty_wk, row.sum_amt_wk, row.sum_profit_wk, row.inv_on_hand_qty_wk


amount = st.integers(1, 500).map(lambda n: Decimal(n) / 100)
small = st.integers(1, 2)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    lines=st.lists(
        st.tuples(small, small, st.integers(0, DAYS + 3), amount, amount, st.none() | amount),
        min_size=1,
        max_size=40,
    ),
    stock=st.lists(
        st.tuples(st.integers(0, DAYS + 3), small, small, st.none() | amount), min_size=1, max_size=25
    ),
)
def test_matches_written_out_pairs(spark, calendar, lines, stock):
    found = {k: _measures(r) for k, r in _computed(spark, calendar, lines, stock).items()}
    assert found == paired(lines, stock)


def test_skewed_key_with_doubles(spark, calendar):
    rng = random.Random(3)
    lines = [(1, 1, rng.randrange(14), 1.0, 2.0, -1.0) for _ in range(3000)]
    lines += [(1, 2 + rng.randrange(50), rng.randrange(DAYS), 1.0, 2.0, 0.5) for _ in range(3000)]
    stock = [(d, i, 1, 4.0) for d in range(0, DAYS, 2) for i in range(1, 40)]
    found = {k: _measures(r) for k, r in _computed(spark, calendar, lines, stock, "double").items()}
    assert found == paired(lines, stock)


def test_pre_aggregate_keeps_true_totals(spark, calendar):
    lines = [(1, 1, 2, Decimal(3), Decimal(30), Decimal(5)), (1, 1, 3, Decimal(4), Decimal(40), Decimal(6))]
    stock = [(2, 1, 1, Decimal(10)), (3, 1, 1, Decimal(20))]
    (once,) = _computed(spark, calendar, lines, stock, pre_aggregate=True).values()
    (repeated,) = _computed(spark, calendar, lines, stock).values()
    assert _measures(once) == (7, 70, 11, 30)
    assert _measures(repeated) == (14, 140, 22, 60)


def test_derived_columns(spark, calendar):
    lines = [(1, 1, 2, Decimal(14), Decimal(28), None), (1, 2, 2, Decimal(14), Decimal(28), None)]
    stock = [(2, 1, 1, None), (2, 2, 1, Decimal(2))]
    found = {k[2]: r for k, r in _computed(spark, calendar, lines, stock).items()}
    assert (found[1].inv_on_hand_qty_wk, found[1].wks_sply, found[1].low_stock_flg_wk) == (0, 0.0, True)
    # two a day against two on hand is not yet low
    assert (found[2].avg_qty_dy, found[2].wks_sply, found[2].low_stock_flg_wk) == (2.0, 2 / 14, False)
    assert found[1].sum_profit_wk is None
    assert found[1].week_end_date - found[1].week_start_date == timedelta(days=6)


def test_one_week_key_on_two_sides_of_a_year(spark, calendar):
    # 2002-12-31 is keyed 200201, away from the 52nd week of the days before it
    lines = [(1, 1, (date(2002, 12, 31) - FIRST).days, Decimal(1), Decimal(1), Decimal(1))]
    stock = [((date(2002, 12, 30) - FIRST).days, 1, 1, Decimal(9))]
    assert _computed(spark, calendar, lines, stock) == {}


def test_item_roll_up(spark, calendar):
    lines = [(w, 1, 2, Decimal(w), Decimal(10 * w), Decimal(1)) for w in (1, 2)]
    stock = [(2, 1, w, Decimal(5)) for w in (1, 2)]
    fact = sales.weekly_sales_inventory(
        spark.createDataFrame(lines, LINES.format("decimal(12,2)")),
        spark.createDataFrame(stock, STOCK.format("decimal(12,2)")),
        calendar,
    )
    (row,) = sales.sales_item_weekly(fact).collect()
    assert (row.sum_qty_wk, row.sum_amt_wk, row.sum_profit_wk) == (3, 30, 2)
