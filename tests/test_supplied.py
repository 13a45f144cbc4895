"""The derived raw tables exercise what the operators are for."""

import pytest
from pyspark.sql import functions as F

from checks.queries import queries
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def found(spark):
    return lambda name: queries()[name](spark, SMALL)


def test_pairing_changes_sales_and_stock(found):
    keys = ["yr_wk_num", "warehouse_sk", "item_sk", "week_start_date"]
    once = found("fact_sales_inv_weekly_preagg")
    both = found("fact_sales_inv_weekly").alias("a").join(once.alias("b"), keys)
    assert both.where("a.sum_qty_wk <> b.sum_qty_wk AND a.sum_amt_wk <> b.sum_amt_wk").count() > 100
    assert both.where("a.inv_on_hand_qty_wk <> b.inv_on_hand_qty_wk").count() > 0


def test_days_have_several_lines_and_some_no_calendar_day(found):
    daily = found("fact_sales_daily")
    assert daily.where("daily_orders > 1").count() > daily.count() / 4
    assert daily.where("sold_date IS NULL").count() > 0


@pytest.mark.parametrize("name", ["dim_item", "dim_warehouse", "dim_customer", "dim_customer_marketing", "full_extract"])
def test_every_column_has_values(found, name):
    df = found(name)
    seen = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    assert [c for c, n in seen.items() if not n] == []


def test_all_labels_occur(found):
    assert found("rfm_segments").select("customer_segment").distinct().count() >= 4


def test_an_extra_column_stays_out_of_the_dimension(spark, tables):
    from martloom.operators import dimensions

    extended = tables.item.withColumn("i_secret", F.lit(1))
    assert dimensions.dim_item(extended).columns == dimensions.dim_item(tables.item).columns


def test_a_doubled_day_is_an_error(spark, tables):
    from martloom.plans.sizing import checked_calendar

    with pytest.raises(ValueError, match="different day keys"):
        checked_calendar(tables.date_dim.union(tables.date_dim.limit(1)))


def test_nothing_is_left_in_the_shared_folder(spark):
    from pathlib import Path

    from martloom.plans import shared

    df = shared.materialize(spark.range(3), "owned")
    path = df.inputFiles()[0].removeprefix("file:")
    kept, shared._WRITTEN[:] = shared._WRITTEN[:-1], shared._WRITTEN[-1:]
    shared.release_shared(spark)
    assert not Path(path).exists()
    shared._WRITTEN[:] = kept


def test_each_sales_table_is_scanned_once_by_the_marketing_job(spark, tmp_path, monkeypatch):
    from martloom.operators import sales
    from martloom.plans import marts

    built = []
    real = sales.incremental_sales
    monkeypatch.setattr(sales, "incremental_sales", lambda *t: built.append(1) or real(*t))
    read = []
    monkeypatch.setattr(marts, "shared", _spy(marts.shared, read))
    from checks.supplied import SuppliedTables

    t = SuppliedTables(spark, SMALL)
    marts.build_marketing_mart({n: t.raw(n) for n in marts.MARKETING_INPUTS}, str(tmp_path))
    assert built == [1] and read == ["calendar", "sales_lines", "customer_activity"]


def _spy(real, names):
    def called(df, name):
        names.append(name)
        return real(df, name)

    return called
