"""Both mart jobs from end to end, from CSV snapshot to SQL."""

import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest

from checks.queries import queries
from martloom import schemas
from martloom.__main__ import main
from martloom.plans import shared as shared_module
from martloom.plans.marts import build_marketing_mart, build_sales_mart
from martloom.sinks import publish
from martloom.sources.readers import read_mart
from tests.conftest import SMALL

ROOT = Path(__file__).resolve().parents[1]

COLUMNS = {
    "dim_date": "date_sk:bigint date:date year:int month:int day:int day_name:string quarter:int "
    "quarter_name:string week_of_year:string yr_wk_num:string week_start_date:date week_end_date:date",
    "fact_sales_inv_weekly": "yr_wk_num:string warehouse_sk:bigint item_sk:bigint week_start_date:date "
    "week_end_date:date sum_qty_wk:double sum_amt_wk:double sum_profit_wk:double inv_on_hand_qty_wk:double "
    "avg_qty_dy:double wks_sply:double low_stock_flg_wk:boolean",
    "fact_returns_with_sales": "yr_wk_num:string item_sk:bigint week_start_date:date week_end_date:date "
    "sum_return_qty_wk:double sum_return_amt_wk:double sum_return_loss_wk:double sum_sales_amt_wk:double "
    "sum_sales_qty_wk:double avg_return_qty_dy:double return_rate_amt:double return_rate_qty:double "
    "high_return_flag_wk:boolean",
    "fact_sales_marketing_daily": "customer_sk:bigint item_sk:bigint promo_sk:bigint channel_key:string "
    "sold_date_sk:bigint sold_date:date sold_yr_num:int sold_mnth_num:int sold_wk_num:string daily_qty:double "
    "daily_sales_amt:double daily_net_profit:double daily_cogs:double daily_orders:bigint",
    "rpt_clv_marketing": "customer_sk:bigint total_sales:double total_profit:double total_orders:bigint "
    "avg_order_value:double avg_profit_per_order:double estimated_lifespan:double CLV:double",
}


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory, tables):
    base = tmp_path_factory.mktemp("mart")
    raw = {name: getattr(tables, name) for name in schemas.RAW_SCHEMAS if hasattr(tables, name)}
    build_sales_mart(raw, f"{base}/sales")
    build_marketing_mart(raw, f"{base}/marketing")
    return str(base)


def test_all_nine_tables_publish(spark, mart):
    names = publish(spark, f"{mart}/sales", schemas.SALES_MART)
    names += publish(spark, f"{mart}/marketing", schemas.MARKETING_MART)
    assert len(names) == 9
    assert all(spark.table(name).count() > 0 for name in names)
    low = spark.sql("SELECT count(*) FROM fact_sales_inv_weekly_table WHERE low_stock_flg_wk").first()[0]
    assert low > 0
    for name in names:  # a view would hide a table of the same name
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, mart, name):
    folder = "marketing" if name in schemas.MARKETING_MART else "sales"
    assert read_mart(spark, f"{mart}/{folder}", name).dtypes == [
        tuple(word.split(":")) for word in COLUMNS[name].split()
    ]


@pytest.mark.parametrize(
    "folder, name, query",
    [
        ("sales", "dim_date", "dim_date"),
        ("sales", "dim_item_sales", "dim_item"),
        ("sales", "dim_warehouse_sales", "dim_warehouse"),
        ("sales", "dim_customer_sales", "dim_customer"),
        ("sales", "fact_sales_inv_weekly", "fact_sales_inv_weekly"),
        ("sales", "fact_returns_with_sales", "fact_returns_with_sales"),
        ("marketing", "fact_sales_marketing_daily", "fact_sales_daily"),
        ("marketing", "rpt_clv_marketing", "customer_clv"),
    ],
)
def test_tables_equal_the_queries(spark, mart, folder, name, query):
    table = read_mart(spark, f"{mart}/{folder}", name)
    other = queries()[query](spark, SMALL)
    assert table.columns == other.columns
    assert table.exceptAll(other).count() == other.exceptAll(table).count() == 0


def test_customer_dimensions_agree(spark, mart):
    plain = read_mart(spark, f"{mart}/sales", "dim_customer_sales")
    labelled = read_mart(spark, f"{mart}/marketing", "dim_customer_marketing")
    assert len(plain.columns) == 35 and labelled.columns[:35] == plain.columns and len(labelled.columns) == 39
    assert labelled.select(plain.columns).exceptAll(plain).count() == 0


def test_written_order(spark, mart):
    fact = read_mart(spark, f"{mart}/sales", "fact_sales_inv_weekly")
    keys = [tuple(r) for r in fact.select("yr_wk_num", "warehouse_sk", "item_sk").collect()]
    assert keys == sorted(keys)


def test_daily_fact_by_year(spark, tables, tmp_path):
    raw = {name: getattr(tables, name) for name in schemas.RAW_SCHEMAS if hasattr(tables, name)}
    build_marketing_mart(raw, str(tmp_path), partition_daily_by_year=True)
    daily = read_mart(spark, str(tmp_path), "fact_sales_marketing_daily")
    plan = daily.where("sold_yr_num = 1998")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sold_yr_num" in plan
    assert daily.where("sold_yr_num = 1998").count() > 0


def test_shared_tables_are_deleted(spark):
    with shared_module.shared(spark.range(3), "passing") as df:
        (path,) = df.inputFiles()[:1]
        assert df.count() == 3
    assert not Path(path.removeprefix("file:")).exists()


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert shared_module.shared_path(spark, "x").startswith(named.rstrip("/"))


def test_command_line(spark, tables, tmp_path):
    """Extract from a database, build from the CSV snapshot, publish as tables."""
    spark.sql("CREATE DATABASE IF NOT EXISTS source")
    zone, day = str(tmp_path / "raw"), "2001-06-30"
    for name, schema in schemas.RAW_SCHEMAS.items():
        df = getattr(tables, name) if hasattr(tables, name) else spark.createDataFrame([], schema)
        df.write.mode("overwrite").saveAsTable(f"source.{name}")
    main(["extract", "--database", "source", "--zone", zone, "--as-of", day])
    folders = {"sales": str(tmp_path / "s"), "marketing": str(tmp_path / "m")}
    for job, folder in folders.items():
        main([job, "--zone", zone, "--as-of", day, "--mart", folder])
    main(["publish", "--mart", folders["sales"], "--marketing-mart", folders["marketing"]])
    fact = spark.table("fact_sales_inv_weekly_table")
    assert fact.count() > 0
    assert fact.agg({"week_start_date": "max"}).first()[0] <= date(2001, 6, 30)
    for name in schemas.SALES_MART + schemas.MARKETING_MART:
        spark.sql(f"DROP TABLE {name}_table")
    spark.sql("DROP DATABASE source CASCADE")


def test_help_needs_no_session():
    done = subprocess.run([sys.executable, "-m", "martloom", "--help"], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0 and "marketing" in done.stdout
