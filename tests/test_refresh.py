"""The refreshed daily fact against a full rebuild, and which files a refresh leaves alone."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.queries import _earlier_lines
from martloom.functions.ratios import decimals_to_double
from martloom.operators.calendar import week_calendar
from martloom.operators.sales import fact_sales_daily, incremental_sales
from martloom.plans import refresh
from martloom.plans.refresh import Refreshed, day_digests, read_daily, refresh_daily, touched_days
from martloom.plans.shared import materialize


@pytest.fixture(scope="module")
def lines(spark, tables):
    sold = incremental_sales(tables.catalog_sales, tables.web_sales, tables.store_sales)
    first = sold.agg(F.min("sold_date_sk")).first()[0]
    # Forty days, a folder for each, and some lines whose day is not known.
    some = sold.where(f"sold_date_sk < {first} + 40")
    unknown = some.where(f"sold_date_sk = {first}").withColumn("sold_date_sk", F.lit(None).cast("long"))
    return materialize(some.union(unknown), "refresh_lines")


@pytest.fixture(scope="module")
def days(tables):
    return materialize(week_calendar(tables.date_dim), "refresh_days")


def same(frame, lines, days):
    whole = decimals_to_double(fact_sales_daily(lines, days))
    assert frame.columns == whole.columns and frame.dtypes == whole.dtypes
    return frame.exceptAll(whole).count() == 0 and whole.exceptAll(frame).count() == 0


def files(base):
    """Data files by day folder."""
    found = {}
    for f in Path(base, refresh.DAILY).glob("_days=*/*.parquet"):
        found.setdefault(f.parent.name, set()).add(f.name)
    return found


def test_first_build_and_nothing_to_do(spark, lines, days, tmp_path):
    built = refresh_daily(lines, days, str(tmp_path))
    assert (built.changed, built.removed) == (0, 0) and built.added == built.days == built.written > 20
    assert same(read_daily(spark, str(tmp_path)), lines, days)
    before = files(tmp_path)
    assert "_days=__HIVE_DEFAULT_PARTITION__" in before
    assert refresh_daily(lines.repartition(7), days, str(tmp_path)) == Refreshed(0, 0, 0, built.days)
    assert files(tmp_path) == before
    # Partitions of another size are built anew, and then hold several days.
    wide = refresh_daily(lines, days, str(tmp_path), partition_days=16)
    assert wide.written <= 5 and wide.added == built.days
    assert same(read_daily(spark, str(tmp_path)), lines, days)
    one = lines.agg(F.max("sold_date_sk")).first()[0]
    fewer = lines.where(f"sold_date_sk IS NULL OR sold_date_sk <> {one}")
    assert refresh_daily(fewer, days, str(tmp_path), partition_days=16).removed == 1
    assert same(read_daily(spark, str(tmp_path)), fewer, days)


def test_added_changed_and_removed_days_alone_are_written(spark, lines, days, tmp_path):
    keys = sorted(r[0] for r in lines.select("sold_date_sk").distinct().collect() if r[0] is not None)
    new, other, gone, doubled = keys[3], keys[8], keys[12], keys[15]
    day = F.col("sold_date_sk")
    earlier = lines.where(~day.eqNullSafe(F.lit(new))).withColumn(
        "daily_qty", F.when(day == other, F.col("daily_qty") + 1).otherwise(F.col("daily_qty")).cast(lines.schema["daily_qty"].dataType)
    )
    later = lines.where(~day.eqNullSafe(F.lit(gone)))
    later = later.union(later.where(day == doubled)).union(lines.where(day.isNull()).limit(1))
    base = str(tmp_path)
    refresh_daily(earlier, days, base)
    before = files(base)
    done = refresh_daily(later, days, base)
    after = files(base)
    assert (done.added, done.changed, done.removed, done.written, done.deleted) == (1, 3, 1, 4, 1)
    touched = {f"_days={d}" for d in (new, other, doubled, "__HIVE_DEFAULT_PARTITION__")}
    assert {d for d in after if after[d] != before.get(d)} == touched
    assert set(before) - set(after) == {f"_days={gone}"}
    assert same(read_daily(spark, base), later, days)


def test_calendar_changes_touch_their_day(spark, lines, days, tmp_path):
    base = str(tmp_path)
    refresh_daily(lines, days, base)
    one = lines.where("sold_date_sk IS NOT NULL").agg(F.min("sold_date_sk")).first()[0]
    moved = days.withColumn("week_of_year", F.when(F.col("date_sk") == one, F.lit("77")).otherwise(F.col("week_of_year")))
    assert refresh_daily(lines, moved, base).changed == 1
    assert same(read_daily(spark, base), lines, moved)


def test_empty_snapshots(spark, lines, days, tmp_path):
    base = str(tmp_path)
    assert refresh_daily(lines.limit(0), days, base) == Refreshed(0, 0, 0, 0)
    assert same(read_daily(spark, base), lines.limit(0), days)
    refresh_daily(lines, days, base)
    done = refresh_daily(lines.limit(0), days, base)
    assert done.removed == done.deleted > 20 and files(base) == {}
    assert read_daily(spark, base).count() == 0


def test_a_refresh_that_stops_is_made_good(spark, lines, days, tmp_path, monkeypatch):
    base = str(tmp_path)
    earlier = lines.where("sold_date_sk % 2 = 0")
    refresh_daily(earlier, days, base)

    def stopped(*_, **__):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(refresh, "write_version", stopped)
        with pytest.raises(OSError, match="stopped"):
            refresh_daily(lines, days, base)
    assert refresh_daily(lines, days, base).added > 0
    assert same(read_daily(spark, base), lines, days)


def test_a_build_without_digests_is_made_anew(spark, lines, days, tmp_path, monkeypatch):
    base = str(tmp_path)
    with monkeypatch.context() as m:
        m.setattr(refresh, "write_version", lambda *a, **k: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            refresh_daily(lines.withColumn("sold_date_sk", F.col("sold_date_sk") + 50_000), days, base)
    refresh_daily(lines, days, base)
    assert same(read_daily(spark, base), lines, days)


def test_digests_see_what_order_and_nulls_hide(spark, lines, days):
    def changed(a, b):
        return {r.sold_date_sk: r.change for r in touched_days(day_digests(a, days), day_digests(b, days)).collect()}

    row = {"sold_date_sk": 7, "customer_sk": 1, "item_sk": None, "promo_sk": 5, "order_number": 1, "channel_key": "Web"}
    schema = "sold_date_sk long, customer_sk long, item_sk long, promo_sk long, order_number long, channel_key string, " \
             "daily_qty double, daily_sales_amt double, daily_net_profit double, daily_cogs double"

    def frame(*rows):
        return spark.createDataFrame([{**row, "daily_qty": 1.0, "daily_sales_amt": 1.0, "daily_net_profit": 1.0, "daily_cogs": 1.0, **r} for r in rows], schema)

    a = frame({}, {"customer_sk": 2}, {"customer_sk": 2})
    assert changed(a, a.repartition(3)) == {}
    assert changed(a, frame({}, {"customer_sk": 2})) == {7: "changed"}
    assert changed(frame({}), frame({"item_sk": 5, "promo_sk": None})) == {7: "changed"}
    assert changed(frame({"sold_date_sk": None}), frame({})) == {None: "removed", 7: "added"}


def test_digests_sum_longs_to_the_same_numbers(lines, days):
    """Halves of the hashes are summed, not decimals; the digests kept beside older tables still hold."""
    digests = day_digests(lines, days)
    plan = digests._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(" not in plan
    nulls = refresh._nulls(refresh.LINE_COLUMNS)
    wide = [
        F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias(name)
        for name, h in (
            ("sum_1", F.xxhash64(*refresh.LINE_COLUMNS, nulls)),
            ("sum_2", F.xxhash64(F.lit("second"), *reversed(refresh.LINE_COLUMNS), nulls)),
        )
    ]
    expected = lines.groupBy("sold_date_sk").agg(*wide)
    found = digests.select(expected.columns)
    assert found.dtypes == expected.dtypes
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_the_earlier_snapshot_is_read_once(spark, tables):
    """The earlier state of the refresh queries, against its parts read one by one."""
    lines = materialize(incremental_sales(tables.catalog_sales, tables.web_sales, tables.store_sales), "earlier_lines")
    found = _earlier_lines(lines)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    second = "pmod(sold_date_sk, 1000) BETWEEN 250 AND 499"
    kind = F.expr(f"IF({second}, sold_date_sk % 11, 0)")
    added = "CAST(IF(" + second + " AND sold_date_sk % 11 = 5 AND item_sk % 3 = 0, daily_qty + 1, daily_qty) AS DECIMAL(10,0))"
    there = lines.where(kind != 3).withColumn("daily_qty", F.expr(added))
    gone = lines.where((kind == 7) & (F.col("item_sk") % 2 == 0))
    moved = lines.where(kind == 9).withColumn("sold_date_sk", F.col("sold_date_sk") + 30_000)
    expected = there.unionByName(gone).unionByName(moved)
    assert found.dtypes == expected.dtypes
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0
