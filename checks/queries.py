"""One query per operator of the inventory, over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.supplied import StoredTables, SuppliedTables
from martloom.functions.labels import SegmentThresholds
from martloom.functions.ratios import decimals_to_double
from martloom.functions.spread import tasks_for
from martloom.operators import calendar, customers, dimensions, returns, sales
from martloom.operators.order_states import merged_activity
from martloom.plans.extract import extract_snapshot
from martloom.plans.refresh import dated_order_states, read_daily, refresh_daily
from martloom.plans.shared import materialize, shared_path
from martloom.plans.sizing import checked_calendar
from martloom.schemas import RAW_SCHEMAS
from martloom.sinks import export_raw, publish, write_bucketed, write_clustered, write_mart
from martloom.sources import history, manifest, readers, snapshots, staging
from martloom.versions import publish_versions, write_version

AS_OF = date(1999, 6, 30)
RANGE = (date(1996, 1, 1), date(1999, 12, 31))
# Limits that spread the supplied customers over the bands.
LIMITS = SegmentThresholds(
    active_days=30,
    lapsing_days=100,
    high_frequency_above=11,
    medium_frequency_from=8,
    high_value_above=1_000_000,
    medium_value_from=600_000,
)
# Fine enough to hit exact order statistics on the supplied tables.
QUANTILE_ERROR = 0.00001
# Days in a partition of refreshed tables: the supplied ones have a few lines a day.
PARTITION_DAYS = 64


class Frames:
    """The frames the queries share, built on demand for one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str, tables: SuppliedTables | StoredTables | None = None):
        self.spark = spark
        self.tables = tables or SuppliedTables(spark, folder)

    @cached_property
    def calendar(self) -> DataFrame:
        return checked_calendar(self.tables.date_dim)

    @cached_property
    def combined_daily_sales(self) -> DataFrame:
        return sales.combined_daily_sales(self.tables.catalog_sales, self.tables.web_sales)

    def weekly(self, pre_aggregate: bool = False) -> DataFrame:
        return sales.weekly_sales_inventory(
            self.combined_daily_sales, self.tables.inventory, self.calendar, pre_aggregate
        )

    @cached_property
    def combined_returns(self) -> DataFrame:
        return returns.combined_returns(self.tables.catalog_returns, self.tables.web_returns)

    @cached_property
    def returns_weekly(self) -> DataFrame:
        return returns.returns_weekly(self.combined_returns, self.calendar)

    @cached_property
    def incremental_sales(self) -> DataFrame:
        t = self.tables
        return sales.incremental_sales(t.catalog_sales, t.web_sales, t.store_sales)

    @cached_property
    def sales_with_date(self) -> DataFrame:
        return sales.sales_with_date(self.incremental_sales, self.calendar)

    @cached_property
    def activity(self) -> DataFrame:
        """Customer activity as a plan; right where it is read once."""
        return customers.customer_activity(self.sales_with_date)

    @cached_property
    def written_activity(self) -> DataFrame:
        """Customer activity as a table; for queries that read it more than once."""
        return materialize(self.activity, "customer_activity")

    @cached_property
    def latest(self) -> DataFrame:
        return customers.latest_sale(self.written_activity)

    @cached_property
    def segments(self) -> DataFrame:
        return customers.rfm_segments(self.written_activity, self.latest, LIMITS)

    @cached_property
    def churn(self) -> DataFrame:
        return customers.churn_by_cohort(self.written_activity, self.latest)

    @cached_property
    def customer_sides(self) -> list[DataFrame]:
        t = self.tables
        return [
            t.customer,
            t.customer_address,
            t.customer_demographics,
            t.household_demographics,
            t.income_band,
        ]


def _csv_roundtrip(f: Frames) -> DataFrame:
    zone = shared_path(f.spark, "csv_roundtrip")
    export_raw(f.tables.catalog_sales, zone, "catalog_sales", AS_OF)
    paths = snapshots.find_snapshot(f.spark, zone, ["catalog_sales"], AS_OF)
    return readers.load_snapshot(f.spark, paths)["catalog_sales"]


def _parquet_roundtrip(f: Frames) -> DataFrame:
    base = shared_path(f.spark, "parquet_roundtrip")
    write_mart(dimensions.dim_item(f.tables.item), base, "dim_item_sales")
    return readers.read_mart(f.spark, base, "dim_item_sales")


def _published_sql(f: Frames) -> DataFrame:
    base = shared_path(f.spark, "published_sql")
    write_mart(calendar.week_calendar(f.tables.date_dim), base, "dim_date")
    write_mart(sales.fact_sales_daily(f.incremental_sales, f.calendar), base, "fact_sales_marketing_daily")
    publish(f.spark, base, ["dim_date", "fact_sales_marketing_daily"])
    return f.spark.sql(
        """
        SELECT d.quarter_name, s.channel_key, sum(s.daily_orders) AS order_lines, sum(s.daily_qty) AS qty
        FROM fact_sales_marketing_daily_table s JOIN dim_date_table d ON s.sold_date_sk = d.date_sk
        GROUP BY d.quarter_name, s.channel_key
        """
    )


def _earlier_lines(lines: DataFrame) -> DataFrame:
    """The sales lines as an earlier snapshot had them, apart on some days.

    By quarters of a thousand days: in the second, days 3 of 11 had no lines yet, days 5 had
    other quantities, days 7 had some lines that are gone now, and the lines of days 9 were there
    a second time on days that are gone now.
    """
    second = F.pmod(F.col("sold_date_sk"), F.lit(1000)).between(250, 499)
    kind = F.when(second, F.col("sold_date_sk") % 11).otherwise(F.lit(0))
    changed = F.when((kind == 5) & (F.col("item_sk") % 3 == 0), F.col("daily_qty") + 1).otherwise(F.col("daily_qty"))
    # How far a line's day lies from those it had: the lines are read once.
    gone = (kind == 7) & (F.col("item_sk") % 2 == 0)
    there = F.when(kind == 3, F.array().cast("array<int>")).when(gone, F.array(F.lit(0), F.lit(0)))
    there = there.when(kind == 9, F.array(F.lit(0), F.lit(30_000))).when(kind.isNotNull(), F.array(F.lit(0)))
    earlier = lines.withColumn("daily_qty", changed.cast(lines.schema["daily_qty"].dataType)).select("*", F.explode(there).alias("_later"))
    return earlier.withColumn("sold_date_sk", F.col("sold_date_sk") + F.col("_later")).drop("_later")


def _fact_sales_daily_refreshed(f: Frames) -> DataFrame:
    base = shared_path(f.spark, "refreshed")
    lines = materialize(f.incremental_sales, "sales_lines")
    for state in (_earlier_lines(lines), lines):
        refresh_daily(state, f.calendar, base, partition_days=PARTITION_DAYS)
    return read_daily(f.spark, base)


def _customer_rfm_merged(f: Frames) -> DataFrame:
    """Customers' figures from states by day, which were kept up to date over two snapshots."""
    base, name = shared_path(f.spark, "order_states"), "order_states"
    lines = materialize(f.incremental_sales, "sales_lines")
    for state in (_earlier_lines(lines), lines):
        refresh_daily(state, f.calendar, base, name, dated_order_states, PARTITION_DAYS)
    return customers.customer_rfm(merged_activity(read_daily(f.spark, base, name)))


def _weekly_bucketed(f: Frames) -> DataFrame:
    """The weekly fact from lines and stock that are stored by the key under which they meet."""
    base, names = shared_path(f.spark, "bucketed"), ("weekly_lines_by_key", "weekly_stock_by_key")
    sides = (
        sales.lines_by_week_key(f.combined_daily_sales, f.calendar),
        sales.stock_by_week_key(f.tables.inventory, f.calendar),
    )
    buckets = int(f.spark.conf.get("spark.sql.shuffle.partitions"))
    for name, side in zip(names, sides, strict=True):
        write_bucketed(side, name, sales.STOCK_KEY, buckets, f"{base}/{name}")
    return sales.weekly_fact(*[f.spark.table(name) for name in names])


def _weekly_clustered(f: Frames) -> DataFrame:
    """The weekly fact written along a curve through week, item and warehouse, and read back."""
    base, name = shared_path(f.spark, "clustered"), "fact_sales_inv_weekly"
    by = {"week": F.col("yr_wk_num").cast("int"), "item": F.col("item_sk"), "warehouse": F.col("warehouse_sk")}
    weekly = materialize(f.weekly(), "weekly")
    write_clustered(weekly, base, name, by, files=max(8, tasks_for(weekly)))
    return readers.read_mart(f.spark, base, name)


def _published_version(f: Frames) -> DataFrame:
    base, name = shared_path(f.spark, "published_version"), "fact_sales_by_version"
    fact = sales.fact_sales_daily(f.incremental_sales, f.calendar)
    for state in (fact.where("channel_key = 'Web'"), fact, fact.where("channel_key = 'Catalog'")):
        write_version(state, base, name)
    publish_versions(f.spark, base, [name], number=-1)
    return f.spark.sql(
        """
        SELECT channel_key, sold_yr_num, sum(daily_orders) AS order_lines, sum(daily_qty) AS qty
        FROM fact_sales_by_version_table GROUP BY channel_key, sold_yr_num
        """
    )


def _csv_rejects(f: Frames) -> DataFrame:
    """Cells of the item table spoilt by key, written as CSV and found in quarantine."""
    folder, sk = shared_path(f.spark, "csv_rejects"), F.col("i_item_sk")
    texts = [c for c, t in f.tables.item.dtypes if t == "string"]
    plain = f.tables.item.select(
        [readers.escaped_lines(c) if c in texts else F.col(c).cast("string").alias(c) for c in f.tables.item.columns]
    )

    def spoilt(column: str, every: int, text: str):
        return F.when(sk % every == 0, F.concat(F.lit(text), sk)).otherwise(F.col(column))

    planted = plain.withColumns(
        {
            "i_current_price": spoilt("i_current_price", 7, "n/a "),
            "i_brand_id": spoilt("i_brand_id", 11, "12x"),
            "i_rec_start_date": spoilt("i_rec_start_date", 13, "soon, "),
            "i_item_sk": spoilt("i_item_sk", 17, "K"),
        }
    )
    planted.write.option("header", True).options(**readers.CSV_FORMAT).csv(f"{folder}/item.csv")
    staging.stage_raw(f.spark, "item", f"{folder}/item.csv", f"{folder}/staged")
    found = staging.quarantine(f.spark, f"{folder}/staged", ["item"])
    return found.select(
        "table_name", "column", "cell", "reason", F.split("record", ",")[0].alias("record_key")
    )


def _as_of_history(f: Frames) -> DataFrame:
    """The item table on three days, from the history of three snapshots that differ."""
    base, sk = shared_path(f.spark, "history"), F.col("i_item_sk")
    item = f.tables.item
    dearer = F.when(sk % 7 == 0, F.col("i_current_price") + 1).otherwise(F.col("i_current_price"))
    second = item.withColumn("i_current_price", dearer)
    third = second.where(sk % 9 != 0)
    states = (item.where(sk % 5 != 1), second, third.unionByName(third.where(sk % 10 == 0)))
    for month, state in enumerate(states, 1):
        history.record(state, base, "item", date(1999, month, 1))
    read = [
        history.as_of(f.spark, base, "item", day).withColumn("as_of", F.lit(day))
        for day in (date(1999, 1, 15), date(1999, 2, 1), date(1999, 3, 31))
    ]
    columns = ["as_of", "i_item_sk", "i_current_price", "i_item_desc", "i_formulation", "i_rec_start_date"]
    return reduce(DataFrame.unionByName, read).select(*columns)


def _snapshot_verified(f: Frames) -> DataFrame:
    """Two tables of a Parquet zone against their manifests."""
    zone = shared_path(f.spark, "snapshot_verified")
    for name in ("item", "catalog_sales"):
        export_raw(f.tables.raw(name), zone, name, AS_OF, "parquet", manifest=True)
    paths = snapshots.find_snapshot(f.spark, zone, ["item", "catalog_sales"], AS_OF)
    return manifest.verify_snapshot(f.spark, paths).groupBy("table_name").agg(
        F.sum("rows").alias("row_count"), F.count_if(F.col("status") != "whole").alias("files_lost")
    )


def _csv_roundtrip_text(f: Frames) -> DataFrame:
    zone = shared_path(f.spark, "csv_roundtrip_text")
    export_raw(f.tables.item, zone, "item", AS_OF)
    return readers.load_snapshot(f.spark, snapshots.find_snapshot(f.spark, zone, ["item"], AS_OF))["item"]


def _extract_snapshot(f: Frames) -> DataFrame:
    zone = shared_path(f.spark, "extract_snapshot")
    tables = {name: f.tables.raw(name) for name in RAW_SCHEMAS}
    return extract_snapshot(f.spark, tables, AS_OF, zone).select("table_name", "row_count", "status")


def _as_of_filter_all(f: Frames) -> DataFrame:
    """Rows kept of every table that has a day key, and the sum of one of its day keys."""
    key = snapshots.as_of_key(f.tables.date_dim, AS_OF)
    kept = []
    for name in RAW_SCHEMAS:
        table = f.tables.raw(name)
        days = [c for c in snapshots.date_key_columns(table) if name != "date_dim"]
        if days:
            summed = next((c for c in days if "sold" in c or "sales" in c), days[0])
            kept.append(
                snapshots.as_of_filter(table, key).agg(
                    F.lit(name).alias("table_name"),
                    F.count(F.lit(1)).alias("row_count"),
                    F.sum(summed).alias("day_keys"),
                )
            )
    return reduce(DataFrame.unionByName, kept)


def _as_of_filter(f: Frames) -> DataFrame:
    key = snapshots.as_of_key(f.tables.date_dim, AS_OF)
    columns = [
        "cs_sold_date_sk",
        "cs_ship_date_sk",
        "cs_bill_customer_sk",
        "cs_warehouse_sk",
        "cs_item_sk",
        "cs_promo_sk",
        "cs_order_number",
        "cs_quantity",
        "cs_net_profit",
    ]
    return snapshots.as_of_filter(f.tables.catalog_sales, key).select(*columns)


def _customer_clv(f: Frames) -> DataFrame:
    return customers.customer_clv(
        customers.customer_summary(f.written_activity), customers.average_lifespan(f.churn)
    )


_QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    # sources and sinks
    "csv_roundtrip": _csv_roundtrip,
    "csv_roundtrip_text": _csv_roundtrip_text,
    "csv_rejects": _csv_rejects,
    "as_of_history": _as_of_history,
    "snapshot_verified": _snapshot_verified,
    "parquet_roundtrip": _parquet_roundtrip,
    "published_sql": _published_sql,
    "published_version": _published_version,
    "as_of_key": lambda f: snapshots.as_of_day(f.tables.date_dim, AS_OF),
    "as_of_filter": _as_of_filter,
    "as_of_filter_all": _as_of_filter_all,
    "calendar_range": lambda f: snapshots.calendar_range(f.tables.date_dim, *RANGE).select(
        "d_date_sk", "d_date", "d_year", "d_moy", "d_dom", "d_qoy", "d_day_name", "d_quarter_name"
    ),
    "full_extract": lambda f: snapshots.as_of_filter(f.tables.item, 0),
    "extract_snapshot": _extract_snapshot,
    # calendar and dimensions
    "dim_date": lambda f: calendar.week_calendar(f.tables.date_dim),
    "dim_date_sunday": lambda f: calendar.week_calendar(f.tables.date_dim, "sunday"),
    "dim_item": lambda f: dimensions.dim_item(f.tables.item),
    "dim_warehouse": lambda f: dimensions.dim_warehouse(f.tables.warehouse),
    "dim_customer": lambda f: dimensions.dim_customer(*f.customer_sides),
    # weekly sales and stock
    "combined_daily_sales": lambda f: f.combined_daily_sales,
    "daily_sales_dated": lambda f: sales.daily_sales_dated(f.combined_daily_sales, f.calendar),
    "inventory_with_date": lambda f: sales.inventory_with_date(f.tables.inventory, f.calendar),
    "fact_sales_inv_weekly": lambda f: f.weekly(),
    "fact_sales_inv_weekly_preagg": lambda f: f.weekly(pre_aggregate=True),
    "fact_sales_inv_weekly_bucketed": _weekly_bucketed,
    "fact_sales_inv_weekly_clustered": _weekly_clustered,
    "sales_item_weekly": lambda f: sales.sales_item_weekly(f.weekly()),
    # returns
    "combined_returns": lambda f: f.combined_returns,
    "returns_weekly": lambda f: f.returns_weekly,
    "fact_returns_with_sales": lambda f: returns.returns_with_sales(
        sales.sales_item_weekly(f.weekly()), f.returns_weekly
    ),
    # marketing
    "incremental_sales": lambda f: f.incremental_sales,
    "sales_with_date": lambda f: f.sales_with_date,
    "fact_sales_daily": lambda f: sales.fact_sales_daily(f.incremental_sales, f.calendar),
    "fact_sales_daily_refreshed": _fact_sales_daily_refreshed,
    "max_sold_date": lambda f: sales.max_sold_date(f.sales_with_date),
    "customer_rfm": lambda f: customers.customer_rfm(f.activity),
    "customer_rfm_merged": _customer_rfm_merged,
    "rfm_segments": lambda f: f.segments,
    "customer_cohorts": lambda f: customers.customer_cohorts(f.activity),
    "churn_by_cohort": lambda f: f.churn,
    "avg_lifespan": lambda f: customers.average_lifespan(f.churn),
    "customer_summary": lambda f: customers.customer_summary(f.activity),
    "customer_clv": _customer_clv,
    "dim_customer_marketing": lambda f: dimensions.dim_customer(*f.customer_sides, segments=f.segments),
    "recency_quantiles": lambda f: customers.recency_quantiles(
        f.written_activity, f.latest, relative_error=QUANTILE_ERROR
    ),
}


def _runner(build: Callable[[Frames], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_to_double(build(Frames(spark, sf_dir)))

    return run


def queries_over(tables: StoredTables) -> dict[str, Callable[[], DataFrame]]:
    """The queries over raw tables that are already stored."""
    return {n: lambda b=build: decimals_to_double(b(Frames(tables.spark, "", tables))) for n, build in _QUERIES.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in _QUERIES.items()}
