from datetime import date, timedelta

import pytest

from martloom.functions.labels import SegmentThresholds
from martloom.operators import customers

LATEST = date(2003, 6, 1)
ACTIVITY = (
    "customer_sk long, first_purchase_date date, last_purchase_date date, orders long, sales_amt double, "
    "profit_amt double, sales_lines long, profit_lines long"
)
SALES = (
    "customer_sk long, sold_date date, order_number long, channel_key string, daily_sales_amt double, "
    "daily_net_profit double"
)


def _ago(days):
    return LATEST - timedelta(days=days)


def _activity(spark, *people):
    """People as (last purchase, orders, amount); a first row sets the latest sale."""
    found = [(0, LATEST, LATEST, 1, 1.0, 1.0, 1, 1)]
    found += [(i, last, last, n, amount, 1.0, 1, 1) for i, (last, n, amount) in enumerate(people, 1)]
    return spark.createDataFrame(found, ACTIVITY)


def _labels(spark, *people, limits=SegmentThresholds()):
    activity = _activity(spark, *people)
    segments = customers.rfm_segments(activity, customers.latest_sale(activity), limits)
    ordered = segments.where("customer_sk > 0").orderBy("customer_sk").collect()
    return [(r.recency_segment, r.frequency_segment, r.monetary_segment, r.customer_segment) for r in ordered]


def test_band_limits(spark):
    days = _labels(spark, *[(_ago(d), 1, 1.0) for d in (0, 100, 101, 300, 301)], (None, 1, 1.0))
    assert [r[0] for r in days] == ["Active", "Active", "Lapsing", "Lapsing", "Inactive", "Inactive"]
    orders = _labels(spark, *[(LATEST, n, 1.0) for n in (2, 3, 5, 6)])
    assert [r[1].split()[0] for r in orders] == ["Low", "Medium", "Medium", "High"]
    amounts = _labels(spark, *[(LATEST, 1, a) for a in (49_999.99, 50_000.0, 100_000.0, 100_000.01, None)])
    assert [r[2].split()[0] for r in amounts] == ["Low", "Medium", "Medium", "High", "Low"]


RECENCY = {"Active": 10, "Lapsing": 200, "Inactive": 400}
FREQUENCY = {"High": 6, "Medium": 4, "Low": 1}
VALUE = {"High": 200_000.0, "Medium": 60_000.0, "Low": 10.0}
NAMED = {
    ("Active", "High", "High"): "Champions",
    ("Active", "Medium", "High"): "Champions",
    ("Lapsing", "High", "High"): "Potential Loyalists",
    ("Lapsing", "Medium", "Medium"): "Hibernating",
    ("Lapsing", "Medium", "High"): "Hibernating",
    ("Active", "Low", "High"): "New User",
    ("Active", "Low", "Medium"): "New User",
    ("Active", "Low", "Low"): "New User",
}


def test_all_twenty_seven_combinations(spark):
    combinations = [(r, f, v) for r in RECENCY for f in FREQUENCY for v in VALUE]
    found = _labels(spark, *[(_ago(RECENCY[r]), FREQUENCY[f], VALUE[v]) for r, f, v in combinations])
    assert [r[3] for r in found] == [NAMED.get(c, "At Risk") for c in combinations]


def test_no_dates_at_all(spark):
    activity = spark.createDataFrame([(1, None, None, 9, 9e9, 1.0, 1, 1)], ACTIVITY)
    latest = customers.latest_sale(activity)
    (row,) = customers.rfm_segments(activity, latest).collect()
    assert (row.recency_segment, row.customer_segment) == ("Inactive", "At Risk")
    churn = customers.churn_by_cohort(activity, latest)
    assert churn.count() == 0
    clv = customers.customer_clv(customers.customer_summary(activity), customers.average_lifespan(churn))
    (row,) = clv.collect()
    assert row.estimated_lifespan is None and row.CLV is None


def _sales(spark):
    return spark.createDataFrame(
        [
            (1, date(2000, 1, 5), 10, "Web", 100.0, 10.0),
            (1, date(2000, 3, 5), 10, "Store", 50.0, None),
            (1, None, 11, "Web", 30.0, 20.0),
            (2, date(2001, 3, 5), 12, "Web", 8.0, 4.0),
        ],
        SALES,
    )


def test_activity_counts_orders_across_channels_and_averages_lines(spark, rows):
    activity = customers.customer_activity(_sales(spark))
    assert rows(customers.customer_cohorts(activity)) == [
        (1, date(2000, 1, 5), date(2000, 3, 5)),
        (2, date(2001, 3, 5), date(2001, 3, 5)),
    ]
    assert rows(customers.customer_rfm(activity)) == [(1, date(2000, 3, 5), 2, 180.0), (2, date(2001, 3, 5), 1, 8.0)]
    assert rows(customers.customer_summary(activity)) == [
        (1, 180.0, 30.0, 2, 60.0, 15.0),
        (2, 8.0, 4.0, 1, 8.0, 4.0),
    ]
    by_channel = customers.customer_activity(_sales(spark), order_key=("channel_key", "order_number"))
    assert rows(by_channel, "customer_sk", "orders") == [(1, 3), (2, 1)]


def test_churn_lifespan_and_value(spark, rows):
    activity = spark.createDataFrame(
        [
            (1, date(2000, 1, 1), date(2000, 2, 1), 1, 10.0, 2.0, 1, 1),
            (2, date(2000, 1, 1), LATEST - timedelta(days=300), 1, 10.0, 4.0, 2, 2),
            (3, date(2001, 1, 1), LATEST, 3, 10.0, 6.0, 1, 1),
            (4, LATEST, LATEST, 1, 10.0, None, 1, 0),
            (5, None, None, 1, 10.0, 1.0, 1, 1),
        ],
        ACTIVITY,
    )
    churn = customers.churn_by_cohort(activity, customers.latest_sale(activity))
    assert rows(churn) == [(2000, 2, 1), (2001, 1, 0)]
    lifespan = customers.average_lifespan(churn)
    assert lifespan.first()[0] == 1.5
    clv = customers.customer_clv(customers.customer_summary(activity), lifespan).collect()
    assert [(r.customer_sk, r.CLV) for r in clv] == [(3, 27.0), (1, 3.0), (2, 3.0), (5, 1.5), (4, None)]


@pytest.mark.parametrize("error", [0.01, 0.0001])
def test_recency_quantiles(spark, error):
    activity = _activity(spark, *[(_ago(d), 1, 1.0) for d in range(1, 1000)], (None, 1, 1.0))
    found = customers.recency_quantiles(activity, customers.latest_sale(activity), relative_error=error)
    for p, days in found.collect():
        assert abs(days - p * 1000) <= error * 1000 + 1
