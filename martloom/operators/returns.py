"""Returns of the catalog and web channels, by week and against sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import ratios
from martloom.operators.calendar import dated


def _returned_lines(raw: DataFrame, prefix: str, amount: str) -> DataFrame:
    p = prefix
    valid = raw.where(
        f"{p}_returned_date_sk IS NOT NULL AND {p}_item_sk IS NOT NULL"
        f" AND {p}_return_quantity > 0 AND {amount} > 0"
    )
    return valid.selectExpr(
        f"{p}_returned_date_sk AS returned_date_sk",
        f"{p}_item_sk AS item_sk",
        f"{p}_return_quantity AS return_qty",
        f"{amount} AS return_amt",
        f"{p}_net_loss AS return_loss",
    )


def combined_returns(catalog_returns: DataFrame, web_returns: DataFrame) -> DataFrame:
    """Return lines with a day, an item, a positive quantity and a positive amount."""
    return _returned_lines(catalog_returns, "cr", "cr_return_amount").unionByName(
        _returned_lines(web_returns, "wr", "wr_return_amt")
    )


def returns_weekly(returns: DataFrame, calendar: DataFrame) -> DataFrame:
    """Returns by week and item; returns on unknown days form a null week."""
    week = ["yr_wk_num", "week_start_date"]
    weekly = (
        dated(returns, calendar, "returned_date_sk", week, how="left")
        .groupBy("yr_wk_num", "item_sk", "week_start_date")
        .agg(
            F.sum("return_qty").alias("sum_return_qty_wk"),
            F.sum("return_amt").alias("sum_return_amt_wk"),
            F.sum("return_loss").alias("sum_return_loss_wk"),
        )
    )
    return weekly.selectExpr(
        "yr_wk_num",
        "item_sk",
        "week_start_date",
        "date_add(week_start_date, 6) AS week_end_date",
        "sum_return_qty_wk",
        "sum_return_amt_wk",
        "sum_return_loss_wk",
    )


def returns_with_sales(
    item_weeks: DataFrame,
    returns: DataFrame,
    match_week_start: bool = False,
    high_return_above: float = 25,
) -> DataFrame:
    """Weekly sales of an item against its returns of the same week.

    A week key covers parts of two or three Sunday-based weeks, so by default a
    sales row meets each return row that shares its key (three at most).

    Args:
        item_weeks: ``sales_item_weekly``.
        returns: ``returns_weekly``.
        match_week_start: pair only rows of the same Sunday-based week.
        high_return_above: percentage of returned amount that raises the flag.
    """
    sold, back = item_weeks.alias("sold"), returns.alias("back")
    key = ["yr_wk_num", "item_sk"] + (["week_start_date"] if match_week_start else [])
    same = [F.col(f"sold.{k}") == F.col(f"back.{k}") for k in key]
    paired = sold.join(back, same, "left").selectExpr(
        "sold.yr_wk_num",
        "sold.item_sk",
        "sold.week_start_date",
        "sold.week_end_date",
        "back.sum_return_qty_wk",
        "back.sum_return_amt_wk",
        "back.sum_return_loss_wk",
        "sold.sum_amt_wk AS sum_sales_amt_wk",
        "sold.sum_qty_wk AS sum_sales_qty_wk",
    )
    amount_rate = ratios.percentage(F.col("sum_return_amt_wk"), F.col("sum_sales_amt_wk"))
    quantity_rate = ratios.percentage(F.col("sum_return_qty_wk"), F.col("sum_sales_qty_wk"))
    return paired.withColumns(
        {
            "avg_return_qty_dy": ratios.per_day(F.col("sum_return_qty_wk")),
            "return_rate_amt": amount_rate,
            "return_rate_qty": quantity_rate,
            "high_return_flag_wk": F.coalesce(amount_rate > high_return_above, F.lit(False)),
        }
    )
