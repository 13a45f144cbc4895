"""Week attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name of a rule -> the day whose ISO week gives the week number.
WEEK_RULES = ("shifted_iso", "sunday")


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.next_day(F.date_sub(day, 7), "Sunday")


def week_end(day: Column) -> Column:
    """The Saturday on or after ``day``."""
    return F.date_add(week_start(day), 6)


def _two_digit_week(day: Column) -> Column:
    return F.lpad(F.weekofyear(day).cast("string"), 2, "0")


def _midweek(day: Column) -> Column:
    """Thursday of the Sunday-based week; its ISO year and week name that week uniquely."""
    return F.date_add(week_start(day), 4)


def week_of_year(day: Column, rule: str = "shifted_iso") -> Column:
    """Two-digit week number.

    ``shifted_iso`` is the ISO week of the day before, so its weeks run Tuesday
    to Monday. ``sunday`` numbers the Sunday-based week itself.
    """
    if rule == "shifted_iso":
        return _two_digit_week(F.date_sub(day, 1))
    if rule == "sunday":
        return _two_digit_week(_midweek(day))
    raise ValueError(f"unknown week rule {rule!r}, expected one of {WEEK_RULES}")


def year_week(day: Column, rule: str = "shifted_iso") -> Column:
    """Year followed by the week number; null for a null day.

    Under ``shifted_iso`` the year is the calendar year, so the last days of
    December can share the key of early January. ``sunday`` has one key per week.
    """
    year = F.year(_midweek(day) if rule == "sunday" else day)
    return F.concat(year.cast("string"), week_of_year(day, rule))
