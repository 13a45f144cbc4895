"""Sales of the three channels, the weekly sales and stock fact, the daily fact."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import ratios
from martloom.functions.spread import dealt, wanted_tasks
from martloom.operators.calendar import dated


@dataclass(frozen=True)
class Channel:
    """Where one sales channel keeps the columns of the common shape."""

    name: str
    prefix: str
    customer: str = "bill_customer_sk"
    site: str = "warehouse_sk"
    order: str = "order_number"
    promo: str | None = "promo_sk"


CATALOG = Channel("Catalog", "cs")
WEB = Channel("Web", "ws")
# Stores record no promotion in the mart, whatever the raw line says.
STORE = Channel("Store", "ss", customer="customer_sk", site="store_sk", order="ticket_number", promo=None)


def sold_lines(raw: DataFrame, channel: Channel) -> DataFrame:
    """Valid lines of one channel in the common shape.

    A line counts if it has a positive quantity and amount, a day, a site
    (warehouse, or store) and a customer. With a positive quantity the amount is
    positive exactly when the price is, and stating it on the bare columns lets
    every condition reach the scan.
    """
    p = channel.prefix
    customer, site = f"{p}_{channel.customer}", f"{p}_{channel.site}"
    promo = f"{p}_{channel.promo}" if channel.promo else "NULL"
    valid = raw.where(
        f"{p}_quantity > 0 AND {p}_sales_price > 0 AND {p}_sold_date_sk IS NOT NULL"
        f" AND {site} IS NOT NULL AND {customer} IS NOT NULL"
    )
    return valid.selectExpr(
        f"{customer} AS customer_sk",
        f"{p}_item_sk AS item_sk",
        f"CAST({promo} AS BIGINT) AS promo_sk",
        f"CAST({p}_{channel.order} AS BIGINT) AS order_number",
        f"'{channel.name}' AS channel_key",
        f"{site} AS warehouse_sk",
        f"{p}_sold_date_sk AS sold_date_sk",
        f"{p}_quantity AS daily_qty",
        f"{p}_quantity * {p}_sales_price AS daily_sales_amt",
        f"{p}_net_profit AS daily_net_profit",
        f"{p}_ext_wholesale_cost AS daily_cogs",
    )


def combined_daily_sales(catalog_sales: DataFrame, web_sales: DataFrame) -> DataFrame:
    """Lines of the two channels that ship from a warehouse."""
    lines = sold_lines(catalog_sales, CATALOG).unionByName(sold_lines(web_sales, WEB))
    return lines.select(
        "warehouse_sk", "item_sk", "sold_date_sk", "daily_qty", "daily_sales_amt", "daily_net_profit"
    )


def incremental_sales(catalog_sales: DataFrame, web_sales: DataFrame, store_sales: DataFrame) -> DataFrame:
    """Lines of all three channels, tagged with their channel."""
    channels = ((catalog_sales, CATALOG), (web_sales, WEB), (store_sales, STORE))
    lines = reduce(DataFrame.unionByName, (sold_lines(raw, channel) for raw, channel in channels))
    return lines.drop("warehouse_sk")


_MEASURES = ("daily_qty", "daily_sales_amt", "daily_net_profit")


def daily_sales_dated(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales by warehouse, item and day with the day's week; unknown days drop out."""
    daily = lines.groupBy("warehouse_sk", "item_sk", "sold_date_sk").agg(
        *[F.sum(m).alias(m) for m in _MEASURES]
    )
    week = ["date", "week_start_date", "week_end_date", "yr_wk_num"]
    return dated(daily, calendar, "sold_date_sk", week)


def inventory_with_date(inventory: DataFrame, calendar: DataFrame) -> DataFrame:
    """Stock snapshots with their day and week; unknown days drop out."""
    stock = inventory.withColumnsRenamed(
        {
            "inv_date_sk": "date_sk",
            "inv_item_sk": "item_sk",
            "inv_warehouse_sk": "warehouse_sk",
            "inv_quantity_on_hand": "quantity_on_hand",
        }
    )
    return dated(stock, calendar, "date_sk", ["date", "yr_wk_num"])


_WEEK_END = "date_add(week_start_date, 6) AS week_end_date"

# A week key is all digits. Grouping and joining use it as a number; the calendar
# converts it once per day and the finished rows convert it back.
_WEEK_NUMBER = "CAST(yr_wk_num AS INT) AS week"
STOCK_KEY = ["week", "warehouse_sk", "item_sk"]


def lines_by_week_key(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales lines with the key ``week, warehouse_sk, item_sk`` under which they meet stock; unknown days drop out."""
    day = [_WEEK_NUMBER, "week_start_date", "shiftleft(1, dayofweek(date)) AS weekday_bit"]
    return dated(lines, calendar, "sold_date_sk", day).select(*STOCK_KEY, "week_start_date", "weekday_bit", *_MEASURES)


def stock_by_week_key(inventory: DataFrame, calendar: DataFrame) -> DataFrame:
    """Stock snapshots with the key ``week, warehouse_sk, item_sk``; unknown days drop out."""
    stock = inventory.selectExpr(
        "inv_date_sk", "inv_warehouse_sk AS warehouse_sk", "inv_item_sk AS item_sk", "inv_quantity_on_hand"
    )
    return dated(stock, calendar, "inv_date_sk", [_WEEK_NUMBER]).select(*STOCK_KEY, "inv_quantity_on_hand")


def _sales_by_week(keyed_lines: DataFrame) -> DataFrame:
    """Sales by week, warehouse and item in a single shuffle.

    ``sale_days`` counts distinct days: each day of the week sets one bit, and
    bits merge in the map-side aggregate like the sums do.
    """
    return keyed_lines.groupBy(*STOCK_KEY, "week_start_date").agg(
        *[F.sum(m).alias(m) for m in _MEASURES],
        F.bit_count(F.bit_or("weekday_bit")).alias("sale_days"),
    )


def _stock_by_week(keyed_stock: DataFrame) -> DataFrame:
    """Stock by week, warehouse and item with the number of snapshots behind it."""
    return keyed_stock.groupBy(*STOCK_KEY).agg(
        F.sum("inv_quantity_on_hand").alias("on_hand"), F.count(F.lit(1)).alias("snapshots")
    )


def weekly_sales_inventory(
    lines: DataFrame, inventory: DataFrame, calendar: DataFrame, pre_aggregate: bool = False
) -> DataFrame:
    """Weekly sales next to the stock of the same week, warehouse and item.

    The fact is defined on the pairing of every day's sales with every stock
    snapshot of its week, so sales count once per snapshot and stock once per
    sale day. Both sides are reduced to one row per key first and the repetition
    is applied as a factor: the same numbers, without ever building the pairs.

    Args:
        lines: ``combined_daily_sales``.
        inventory: raw inventory.
        calendar: ``week_calendar``; exactly one row per day, as the counts of days rely on it.
        pre_aggregate: leave the factors out, giving true weekly totals.
    """
    return weekly_fact(lines_by_week_key(lines, calendar), stock_by_week_key(inventory, calendar), pre_aggregate)


def weekly_fact(keyed_lines: DataFrame, keyed_stock: DataFrame, pre_aggregate: bool = False) -> DataFrame:
    """``weekly_sales_inventory`` from ``lines_by_week_key`` and ``stock_by_week_key``.

    Both may be tables that are stored by that key (``sinks.write_bucketed``): then
    neither the sums nor the join move a row.
    """
    joined = _sales_by_week(keyed_lines).join(_stock_by_week(keyed_stock), STOCK_KEY)
    per_snapshot, per_sale_day = ("1", "1") if pre_aggregate else ("snapshots", "sale_days")
    totals = joined.selectExpr(
        "CAST(week AS STRING) AS yr_wk_num",
        "warehouse_sk",
        "item_sk",
        "week_start_date",
        _WEEK_END,
        f"daily_qty * {per_snapshot} AS sum_qty_wk",
        f"daily_sales_amt * {per_snapshot} AS sum_amt_wk",
        f"daily_net_profit * {per_snapshot} AS sum_profit_wk",
        f"coalesce(on_hand * {per_sale_day}, 0) AS inv_on_hand_qty_wk",
    )
    sold, on_hand = F.col("sum_qty_wk"), F.col("inv_on_hand_qty_wk")
    pace = ratios.per_day(sold)
    return totals.withColumns(
        {
            "avg_qty_dy": pace,
            "wks_sply": ratios.ratio(on_hand, sold),
            "low_stock_flg_wk": (pace > 0) & (pace > on_hand.cast("double")),
        }
    )


def sales_item_weekly(weekly: DataFrame) -> DataFrame:
    """The weekly fact rolled up over warehouses."""
    rolled = weekly.groupBy("yr_wk_num", "item_sk", "week_start_date").agg(
        F.sum("sum_qty_wk").alias("sum_qty_wk"),
        F.sum("sum_amt_wk").alias("sum_amt_wk"),
        F.sum("sum_profit_wk").alias("sum_profit_wk"),
    )
    return rolled.selectExpr(
        "yr_wk_num", "item_sk", "week_start_date", _WEEK_END, "sum_qty_wk", "sum_amt_wk", "sum_profit_wk"
    )


_SOLD_DATE = {
    "date": "sold_date",
    "year": "sold_yr_num",
    "month": "sold_mnth_num",
    "week_of_year": "sold_wk_num",
}


def _with_sold_date(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    found = dated(sales, calendar, "sold_date_sk", list(_SOLD_DATE), how="left")
    return found.withColumnsRenamed(_SOLD_DATE)


def sales_with_date(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales lines with the attributes of their day; null attributes for unknown days."""
    return _with_sold_date(sales, calendar).select(
        "customer_sk",
        "item_sk",
        "promo_sk",
        "channel_key",
        "sold_date_sk",
        *_SOLD_DATE.values(),
        *_MEASURES,
        "daily_cogs",
        "order_number",
    )


def fact_sales_daily(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales by customer, item, promotion, channel and day.

    The day's attributes depend on its key alone, so they are looked up on the
    aggregated rows and never travel through the shuffle. There are about as many
    sums as lines, so the lines of a large table are dealt over more tasks than the
    session's shuffles have, before they are summed.

    Args:
        sales: ``incremental_sales``.
        calendar: ``week_calendar``, one row per day.
    """
    measures = (*_MEASURES, "daily_cogs")
    key = ["customer_sk", "item_sk", "promo_sk", "channel_key", "sold_date_sk"]
    daily = dealt(sales, key, wanted_tasks(sales)).groupBy(*key).agg(
        *[F.sum(m).alias(m) for m in measures],
        F.count("order_number").alias("daily_orders"),
    )
    return _with_sold_date(daily, calendar).select(
        *key, *_SOLD_DATE.values(), *measures, "daily_orders"
    )


def max_sold_date(sales: DataFrame) -> DataFrame:
    """One row with the latest known sale date."""
    return sales.agg(F.max("sold_date").alias("max_sold_date"))
