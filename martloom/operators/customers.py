"""Customer value: activity, segments, cohorts, churn and lifetime value.

Everything here derives from one aggregate, ``customer_activity``. Reports that
read it more than once (the latest sale date is a maximum over it) expect it as
a written table; see ``plans.shared``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import labels, ratios
from martloom.functions.labels import SegmentThresholds


def customer_activity(sales: DataFrame, order_key: Sequence[str] = ("order_number",)) -> DataFrame:
    """One row per customer with all that the customer reports need.

    Spark computes the distinct orders by (customer, order) first, so a customer
    with a large share of the lines is spread over many tasks.

    Args:
        sales: ``sales_with_date``.
        order_key: columns that identify an order. The order number alone counts
            equal numbers of two channels once; add ``channel_key`` to tell them apart.
    """
    return sales.groupBy("customer_sk").agg(
        F.min("sold_date").alias("first_purchase_date"),
        F.max("sold_date").alias("last_purchase_date"),
        F.count_distinct(*order_key).alias("orders"),
        F.sum("daily_sales_amt").alias("sales_amt"),
        F.sum("daily_net_profit").alias("profit_amt"),
        F.count("daily_sales_amt").alias("sales_lines"),
        F.count("daily_net_profit").alias("profit_lines"),
    )


def latest_sale(activity: DataFrame) -> DataFrame:
    """One row with the latest known sale date; null if no sale has a date."""
    return activity.agg(F.max("last_purchase_date").alias("max_sold_date"))


def customer_rfm(activity: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value of each customer."""
    return activity.selectExpr(
        "customer_sk",
        "last_purchase_date AS recent_purchase",
        "orders AS frequency",
        "sales_amt AS monetary",
    )


def rfm_segments(
    activity: DataFrame, latest: DataFrame, limits: SegmentThresholds = SegmentThresholds()
) -> DataFrame:
    """Customers with a label for each RFM measure and an overall segment.

    Args:
        activity: ``customer_activity``.
        latest: ``latest_sale``; used as a scalar subquery.
        limits: band limits.
    """
    rfm = customer_rfm(activity).select(
        "*",
        labels.recency_label(F.col("recent_purchase"), latest.scalar(), limits).alias("recency_segment"),
        labels.frequency_label(F.col("frequency"), limits).alias("frequency_segment"),
        labels.value_label(F.col("monetary"), limits).alias("monetary_segment"),
    )
    return rfm.withColumn(
        "customer_segment",
        labels.segment_label(
            F.col("recency_segment"), F.col("frequency_segment"), F.col("monetary_segment")
        ),
    )


def customer_cohorts(activity: DataFrame) -> DataFrame:
    """First and last purchase of each customer."""
    return activity.select("customer_sk", "first_purchase_date", "last_purchase_date")


def churn_by_cohort(activity: DataFrame, latest: DataFrame, churn_days: int = 300) -> DataFrame:
    """Customers and churned customers by year of first purchase.

    A customer is churned after ``churn_days`` without a purchase. Only years
    before the year of the latest sale are reported.
    """
    churned = F.col("last_purchase_date") < F.date_sub(latest.scalar(), churn_days)
    return (
        activity.groupBy(F.year("first_purchase_date").alias("cohort_year"))
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.count_if(churned).alias("churned_customers"),
        )
        .where(F.col("cohort_year") < F.year(latest.scalar()))
    )


def average_lifespan(churn: DataFrame) -> DataFrame:
    """One row: mean over cohorts of customers per churned customer (no churn counts as one).

    The cohorts, one per year, are added up in the order of the years, so that the
    last digits do not depend on which task came first. No cohorts give null.
    """
    lifespan = F.col("total_customers") / F.greatest("churned_customers", F.lit(1))
    by_year = F.array_sort(F.collect_list(F.struct("cohort_year", lifespan.alias("lifespan"))))
    total = F.aggregate(by_year, F.lit(0.0), lambda so_far, cohort: so_far + cohort["lifespan"])
    return churn.agg(F.try_divide(total, F.count(F.lit(1))).alias("avg_estimated_lifespan"))


def customer_summary(activity: DataFrame) -> DataFrame:
    """Totals of each customer. Averages are per line, not per order."""
    return activity.select(
        "customer_sk",
        F.col("sales_amt").alias("total_sales"),
        F.col("profit_amt").alias("total_profit"),
        F.col("orders").alias("total_orders"),
        ratios.mean(F.col("sales_amt"), F.col("sales_lines")).alias("avg_order_value"),
        ratios.mean(F.col("profit_amt"), F.col("profit_lines")).alias("avg_profit_per_order"),
    )


def customer_clv(summary: DataFrame, lifespan: DataFrame) -> DataFrame:
    """Lifetime value of each customer, best first.

    The customer key breaks ties, which also keeps the sort spread out when the
    value is null throughout.

    Args:
        summary: ``customer_summary``.
        lifespan: ``average_lifespan``; used as a scalar subquery.
    """
    value = F.col("avg_profit_per_order") * F.col("total_orders") * F.col("estimated_lifespan")
    return (
        summary.withColumn("estimated_lifespan", lifespan.scalar())
        .withColumn("CLV", value)
        .orderBy(F.desc_nulls_last("CLV"), "customer_sk")
    )


def recency_quantiles(
    activity: DataFrame,
    latest: DataFrame,
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    relative_error: float = 0.01,
) -> DataFrame:
    """Quantiles of the days since a customer's last purchase, one row per probability.

    Calibrates the recency limits. Uses a mergeable sketch, so no customer list
    is gathered anywhere.
    """
    days = F.datediff(latest.scalar(), F.col("last_purchase_date"))
    accuracy = max(1, round(1 / relative_error))
    points = F.percentile_approx("days", list(probabilities), accuracy)
    labelled = F.arrays_zip(
        F.array(*[F.lit(float(p)) for p in probabilities]).alias("probability"),
        F.col("points").alias("days_since_last_purchase"),
    )
    return (
        activity.select(days.alias("days"))
        .agg(points.alias("points"))
        .select(F.inline(labelled))
    )
