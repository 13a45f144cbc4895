from datetime import date

import pytest

from martloom.operators import returns
from martloom.schemas import RAW_SCHEMAS

SUNDAY, NEXT_SUNDAY = date(2000, 1, 2), date(2000, 1, 9)
SOLD = "yr_wk_num string, item_sk long, week_start_date date, week_end_date date, sum_qty_wk double, sum_amt_wk double, sum_profit_wk double"
BACK = "yr_wk_num string, item_sk long, week_start_date date, week_end_date date, sum_return_qty_wk double, sum_return_amt_wk double, sum_return_loss_wk double"


def _against(spark, sold, back, **options):
    sold = [("200001", i, w, w, q, a, 0.0) for i, w, q, a in sold]
    back = [("200001", i, w, w, q, a, 0.0) for i, w, q, a in back]
    return returns.returns_with_sales(
        spark.createDataFrame(sold, SOLD), spark.createDataFrame(back, BACK), **options
    )


def test_sales_without_returns_keep_nulls_and_no_flag(spark):
    (row,) = _against(spark, [(1, SUNDAY, 10.0, 100.0)], []).collect()
    assert row.sum_return_qty_wk is row.return_rate_amt is row.avg_return_qty_dy is None
    assert row.high_return_flag_wk is False


def test_no_sales_amount_means_rate_zero(spark):
    (row,) = _against(spark, [(1, SUNDAY, 0.0, 0.0)], [(1, SUNDAY, 1.0, 5.0)]).collect()
    assert (row.return_rate_amt, row.return_rate_qty, row.high_return_flag_wk) == (0.0, 0.0, False)


@pytest.mark.parametrize("amount, rate, flag", [(25.0, 25.0, False), (25.004, 25.0, False), (25.01, 25.01, True)])
def test_flag_compares_the_rounded_rate(spark, amount, rate, flag):
    (row,) = _against(spark, [(1, SUNDAY, 7.0, 100.0)], [(1, SUNDAY, 7.0, amount)]).collect()
    assert (row.return_rate_amt, row.high_return_flag_wk, row.avg_return_qty_dy) == (rate, flag, 1.0)


def test_a_sales_row_meets_every_return_row_of_its_key(spark, rows):
    sold = [(1, SUNDAY, 10.0, 100.0)]
    back = [(1, SUNDAY, 1.0, 10.0), (1, NEXT_SUNDAY, 2.0, 20.0)]
    assert rows(_against(spark, sold, back), "sum_return_qty_wk") == [(1.0,), (2.0,)]
    assert rows(_against(spark, sold, back, match_week_start=True), "sum_return_qty_wk") == [(1.0,)]


def test_return_lines_and_null_week(spark, rows):
    schema = RAW_SCHEMAS["web_returns"]

    def line(**values):
        return tuple(values.get(n.removeprefix("wr_")) for n in schema.names)

    good = {"returned_date_sk": 1.0, "item_sk": 2.0, "return_quantity": 3.0, "return_amt": 4.0, "net_loss": 5.0}
    broken = ({"returned_date_sk": None}, {"item_sk": None}, {"return_quantity": 0.0}, {"return_amt": 0.0})
    web = spark.createDataFrame([line(**good), line(**good)] + [line(**{**good, **b}) for b in broken], schema)
    catalog = spark.createDataFrame([], RAW_SCHEMAS["catalog_returns"])
    combined = returns.combined_returns(catalog, web)
    assert combined.count() == 2
    calendar = spark.createDataFrame([], "date_sk long, yr_wk_num string, week_start_date date")
    weekly = returns.returns_weekly(combined, calendar)
    assert rows(weekly) == [(None, 2.0, None, None, 6.0, 8.0, 10.0)]
