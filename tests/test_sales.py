import pytest

from martloom.operators import sales
from martloom.schemas import RAW_SCHEMAS

GOOD = {
    "cs": {"quantity": 2.0, "sales_price": 3.0, "sold_date_sk": 1.0, "warehouse_sk": 4.0, "bill_customer_sk": 5.0},
    "ws": {"quantity": 2.0, "sales_price": 3.0, "sold_date_sk": 1.0, "warehouse_sk": 4.0, "bill_customer_sk": 5.0},
    "ss": {"quantity": 2.0, "sales_price": 3.0, "sold_date_sk": 1.0, "store_sk": 4.0, "customer_sk": 5.0},
}
TABLE = {"cs": "catalog_sales", "ws": "web_sales", "ss": "store_sales"}
CHANNEL = {"cs": sales.CATALOG, "ws": sales.WEB, "ss": sales.STORE}


def _raw(spark, prefix, *changes):
    schema = RAW_SCHEMAS[TABLE[prefix]]
    lines = []
    for number, change in enumerate(changes):
        values = {**GOOD[prefix], "item_sk": float(number), **change}
        lines.append(tuple(values.get(name.removeprefix(prefix + "_")) for name in schema.names))
    return spark.createDataFrame(lines, schema)


@pytest.mark.parametrize("prefix", ["cs", "ws", "ss"])
def test_each_condition_rejects(spark, prefix):
    required = ["quantity", "sales_price", "sold_date_sk"]
    required += ["store_sk", "customer_sk"] if prefix == "ss" else ["warehouse_sk", "bill_customer_sk"]
    bad = [{name: None} for name in required]
    bad += [{"quantity": 0.0}, {"quantity": -1.0}, {"sales_price": 0.0}, {"sales_price": -2.0}]
    bad += [{"quantity": -1.0, "sales_price": -2.0}]
    kept = sales.sold_lines(_raw(spark, prefix, {}, *bad), CHANNEL[prefix]).collect()
    assert [(r.item_sk, r.daily_qty, r.daily_sales_amt) for r in kept] == [(0.0, 2.0, 6.0)]


def test_store_lines_need_no_warehouse_and_lose_their_promotion(spark):
    raw = _raw(spark, "ss", {"promo_sk": 7.0, "ticket_number": 9.0})
    (line,) = sales.sold_lines(raw, sales.STORE).collect()
    assert (line.promo_sk, line.order_number, line.channel_key, line.customer_sk) == (None, 9, "Store", 5.0)


def test_duplicates_survive_the_union(spark):
    raw = [_raw(spark, p, {"item_sk": 1.0}, {"item_sk": 1.0}) for p in ("cs", "ws", "ss")]
    assert sales.combined_daily_sales(*raw[:2]).count() == 4
    combined = sales.incremental_sales(*raw)
    assert combined.count() == 6
    assert dict(combined.dtypes)["order_number"] == dict(combined.dtypes)["promo_sk"] == "bigint"


def test_daily_fact_counts_lines_and_keeps_null_promotions(spark, rows):
    calendar = spark.createDataFrame(
        [], "date_sk long, date date, year int, month int, week_of_year string"
    )
    lines = spark.createDataFrame(
        [
            (1, 1, None, 10, "Web", 5, 1.0, 2.0, 3.0, 4.0),
            (1, 1, None, 10, "Web", 5, 1.0, 2.0, 3.0, 4.0),
            (1, 1, None, None, "Web", 5, 1.0, 2.0, 3.0, 4.0),
            (1, 1, 8, 10, "Web", 5, 1.0, 2.0, 3.0, 4.0),
        ],
        "customer_sk long, item_sk long, promo_sk long, order_number long, channel_key string, "
        "sold_date_sk long, daily_qty double, daily_sales_amt double, daily_net_profit double, daily_cogs double",
    )
    daily = sales.fact_sales_daily(lines, calendar)
    assert rows(daily, "promo_sk", "sold_date", "daily_qty", "daily_orders") == [
        (8, None, 1.0, 1),
        (None, None, 3.0, 2),
    ]
    assert sales.max_sold_date(sales.sales_with_date(lines, calendar)).first()[0] is None
