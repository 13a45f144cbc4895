"""The week calendar and how facts get their dates from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import weeks


def week_calendar(date_dim: DataFrame, week_rule: str = "shifted_iso") -> DataFrame:
    """One row per day with its calendar and week attributes (``dim_date``).

    Args:
        date_dim: raw calendar, one row per day.
        week_rule: ``shifted_iso`` or ``sunday``, see ``functions.weeks``.
    """
    day = F.col("d_date")
    renamed = {
        "d_date_sk": "date_sk",
        "d_date": "date",
        "d_year": "year",
        "d_moy": "month",
        "d_dom": "day",
        "d_day_name": "day_name",
        "d_qoy": "quarter",
        "d_quarter_name": "quarter_name",
    }
    return date_dim.select(
        *[F.col(raw).alias(name) for raw, name in renamed.items()],
        weeks.week_of_year(day, week_rule).alias("week_of_year"),
        weeks.year_week(day, week_rule).alias("yr_wk_num"),
        weeks.week_start(day).alias("week_start_date"),
        weeks.week_end(day).alias("week_end_date"),
    )


def dated(
    facts: DataFrame, calendar: DataFrame, key: str, attributes: list[str], how: str = "inner"
) -> DataFrame:
    """Look up calendar ``attributes`` by the day key of each fact row.

    The calendar decides the join: one that was size-checked and hinted for
    broadcast (``plans.sizing``) keeps the facts where they are; otherwise Spark
    chooses by its own statistics.
    """
    days = calendar.selectExpr("date_sk AS _day_key", *attributes)
    return facts.join(days, facts[key] == days["_day_key"], how).drop("_day_key")
