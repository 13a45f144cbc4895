from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martloom.functions import weeks
from martloom.operators.calendar import dated, week_calendar

FIRST, LAST = date(1990, 1, 1), date(2030, 1, 1)


def _calendar(spark, rule="shifted_iso"):
    n = (LAST - FIRST).days + 1
    day = F.date_add(F.lit(FIRST), F.col("id").cast("int"))
    raw = spark.range(n).select(
        F.col("id").alias("d_date_sk"),
        day.alias("d_date"),
        F.year(day).alias("d_year"),
        F.month(day).alias("d_moy"),
        F.dayofmonth(day).alias("d_dom"),
        F.date_format(day, "EEEE").alias("d_day_name"),
        F.quarter(day).alias("d_qoy"),
        F.lit("q").alias("d_quarter_name"),
    )
    return week_calendar(raw, rule)


def test_every_day_of_forty_years(spark):
    found = _calendar(spark).collect()
    assert len(found) == 14611
    for row in found:
        day = row["date"]
        week = (day - timedelta(days=1)).isocalendar().week
        start = day - timedelta(days=day.isoweekday() % 7)
        assert row["week_of_year"] == f"{week:02d}"
        assert row["yr_wk_num"] == f"{day.year}{week:02d}"
        assert (row["week_start_date"], row["week_end_date"]) == (start, start + timedelta(days=6))


def test_default_key_spans_weeks_and_repeats_at_year_end(spark):
    by_day = {r["date"]: r["yr_wk_num"] for r in _calendar(spark).collect()}
    assert by_day[date(2002, 12, 31)] == by_day[date(2002, 1, 1)] == "200201"
    assert by_day[date(2002, 6, 9)] != by_day[date(2002, 6, 11)]  # one Sunday-based week


def test_sunday_rule_names_each_week_once(spark):
    keys, starts = defaultdict(set), defaultdict(set)
    for row in _calendar(spark, "sunday").collect():
        keys[row["week_start_date"]].add(row["yr_wk_num"])
        starts[row["yr_wk_num"]].add(row["week_start_date"])
        assert row["yr_wk_num"].endswith(row["week_of_year"])
    assert all(len(v) == 1 for v in keys.values())
    assert all(len(v) == 1 for v in starts.values())


def test_unknown_rule(spark):
    with pytest.raises(ValueError, match="unknown week rule"):
        weeks.week_of_year(F.lit(FIRST), "monday")


def test_null_day_has_null_week(spark):
    row = spark.range(1).select(weeks.year_week(F.lit(None).cast("date")).alias("k")).first()
    assert row["k"] is None


def test_dated_inner_and_left(spark, rows):
    calendar = _calendar(spark)
    facts = spark.createDataFrame([(0, "a"), (99999, "b"), (None, "c")], "k long, v string")
    assert rows(dated(facts, calendar, "k", ["date"])) == [(0, "a", FIRST)]
    assert rows(dated(facts, calendar, "k", ["date"], "left"), "v", "date") == [
        ("a", FIRST),
        ("b", None),
        ("c", None),
    ]
