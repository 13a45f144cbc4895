"""Broadcasting only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.calendar import week_calendar
from martloom.plans.shared import materialize

# About 400 years of days, a dozen megabytes of week attributes.
MAX_CALENDAR_DAYS = 150_000


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint ``df`` for broadcast if it has at most ``max_rows`` rows.

    The rows are counted, once, by a distributed job. A larger frame comes back
    without the hint and joins by shuffle, where adaptive execution splits skewed keys.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def joined_days(days: DataFrame) -> DataFrame:
    """A stored week calendar, ready for facts to look up.

    Rows and different keys are counted in one pass. Facts are joined after they
    were summed, so a day key that occurs twice would repeat finished rows: an error.
    """
    rows, keys = days.agg(F.count(F.lit(1)), F.count_distinct("date_sk")).first()
    if rows != keys:
        raise ValueError(f"the calendar has {rows} days but {keys} different day keys")
    return F.broadcast(days) if rows <= MAX_CALENDAR_DAYS else days


def checked_calendar(date_dim: DataFrame, week_rule: str = "shifted_iso") -> DataFrame:
    """Week calendar that facts can look up without being shuffled.

    It is written once, so that counting and broadcasting it read a small file and
    the calendar is not derived again.
    """
    return joined_days(materialize(week_calendar(date_dim, week_rule), "calendar"))
