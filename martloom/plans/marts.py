"""The two mart jobs. Shared frames are written once, then every table from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from martloom.functions.labels import SegmentThresholds
from martloom.operators import customers, dimensions, returns, sales
from martloom.operators.calendar import week_calendar
from martloom.plans.shared import shared
from martloom.plans.sizing import joined_days
from martloom.sinks import write_mart
from martloom.sources.readers import read_mart
from martloom.versions import read_version, write_version

# Raw tables each job reads.
SALES_INPUTS = (
    "catalog_returns",
    "catalog_sales",
    "customer",
    "customer_address",
    "customer_demographics",
    "date_dim",
    "household_demographics",
    "income_band",
    "inventory",
    "item",
    "warehouse",
    "web_returns",
    "web_sales",
)
MARKETING_INPUTS = (
    "catalog_sales",
    "customer",
    "customer_address",
    "customer_demographics",
    "date_dim",
    "household_demographics",
    "income_band",
    "store_sales",
    "web_sales",
)
_CUSTOMER_TABLES = (
    "customer",
    "customer_address",
    "customer_demographics",
    "household_demographics",
    "income_band",
)


def _storage(versioned: bool) -> tuple[Callable[..., object], Callable[..., DataFrame]]:
    """How mart tables are written, and read back."""
    return (write_version, read_version) if versioned else (write_mart, read_mart)


def build_sales_mart(
    raw: Mapping[str, DataFrame],
    base: str,
    week_rule: str = "shifted_iso",
    pre_aggregate: bool = False,
    match_week_start: bool = False,
    versioned: bool = False,
) -> None:
    """Write the six sales tables under ``base``.

    The weekly fact feeds both its own table and the returns fact, so it is
    computed once. Sorting happens only on the way out.

    Args:
        versioned: write new versions of the tables instead of replacing them.
    """
    write_mart, read_mart = _storage(versioned)
    days = week_calendar(raw["date_dim"], week_rule)
    write_mart(days, base, "dim_date")
    write_mart(dimensions.dim_item(raw["item"]), base, "dim_item_sales")
    write_mart(dimensions.dim_warehouse(raw["warehouse"]), base, "dim_warehouse_sales")
    write_mart(
        dimensions.dim_customer(*[raw[name] for name in _CUSTOMER_TABLES]), base, "dim_customer_sales"
    )

    # Counting and broadcasting the table just written spares reading the raw calendar again.
    calendar = joined_days(read_mart(days.sparkSession, base, "dim_date"))
    lines = sales.combined_daily_sales(raw["catalog_sales"], raw["web_sales"])
    fact = sales.weekly_sales_inventory(lines, raw["inventory"], calendar, pre_aggregate)
    with shared(fact, "weekly_sales_inventory") as weekly:
        write_mart(
            weekly.orderBy("yr_wk_num", "warehouse_sk", "item_sk", "week_start_date"),
            base,
            "fact_sales_inv_weekly",
        )
        returned = returns.combined_returns(raw["catalog_returns"], raw["web_returns"])
        against_sales = returns.returns_with_sales(
            sales.sales_item_weekly(weekly),
            returns.returns_weekly(returned, calendar),
            match_week_start=match_week_start,
        )
        write_mart(
            against_sales.orderBy("yr_wk_num", "item_sk", "week_start_date"),
            base,
            "fact_returns_with_sales",
        )


def build_marketing_mart(
    raw: Mapping[str, DataFrame],
    base: str,
    limits: SegmentThresholds = SegmentThresholds(),
    churn_days: int = 300,
    partition_daily_by_year: bool = False,
    order_key: Sequence[str] = ("order_number",),
    versioned: bool = False,
) -> None:
    """Write the three marketing tables under ``base``.

    The raw sales are read once: their valid lines, ten columns wide, are written to
    the shared folder, and both the daily fact and the customer reports start there.

    Args:
        order_key: columns that tell orders apart.
        partition_daily_by_year: lay the daily fact out by ``sold_yr_num`` so that
            readers of a year skip the others.
        versioned: write new versions of the tables instead of replacing them.
    """
    write_mart, _ = _storage(versioned)
    with shared(week_calendar(raw["date_dim"]), "calendar") as days:
        calendar = joined_days(days)
        valid = sales.incremental_sales(raw["catalog_sales"], raw["web_sales"], raw["store_sales"])
        with shared(valid, "sales_lines") as lines:
            write_mart(
                sales.fact_sales_daily(lines, calendar),
                base,
                "fact_sales_marketing_daily",
                partition_by=("sold_yr_num",) if partition_daily_by_year else (),
            )
            per_customer = customers.customer_activity(
                sales.sales_with_date(lines, calendar), order_key=order_key
            )
            with shared(per_customer, "customer_activity") as activity:
                _write_customer_reports(raw, base, activity, limits, churn_days, write_mart)


def _write_customer_reports(
    raw: Mapping[str, DataFrame],
    base: str,
    activity: DataFrame,
    limits: SegmentThresholds,
    churn_days: int,
    write_mart: Callable[..., object],
) -> None:
    latest = customers.latest_sale(activity)
    churn = customers.churn_by_cohort(activity, latest, churn_days)
    write_mart(
        customers.customer_clv(customers.customer_summary(activity), customers.average_lifespan(churn)),
        base,
        "rpt_clv_marketing",
    )
    segments = customers.rfm_segments(activity, latest, limits)
    write_mart(
        dimensions.dim_customer(*[raw[name] for name in _CUSTOMER_TABLES], segments=segments),
        base,
        "dim_customer_marketing",
    )
