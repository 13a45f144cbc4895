"""The supplied order tables seen as the raw retail tables.

Formulas and the reasons for the injected nulls and zeros are in FIXTURES.md,
part C. Money and quantities are decimals so that sums do not depend on order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from martloom.functions.spread import dealt, tasks_for, wanted_tasks
from martloom.schemas import RAW_SCHEMAS, is_key


def _day_key(day: str) -> str:
    """Julian day number of a date."""
    return f"CAST(unix_date({day}) + 2440588 AS BIGINT)"


# Key of a market segment, from its first two letters.
SEGMENT_KEY = "CAST(ascii(c_mktsegment) * 256 + ascii(substr(c_mktsegment, 2, 1)) AS BIGINT)"


def _null_if(gap: str, value: str) -> str:
    return f"IF({gap}, NULL, {value})"


def filler(kind: str, name: str, position: int, key: str) -> str:
    """Value of a dimension column that has no formula of its own, from the row's key; null in one row of 31."""
    value = {
        "string": f"'{name} ' || CAST({key} % {position + 3} AS STRING)",
        "double": f"CAST({key} * {position + 1} % 97 AS DOUBLE)",
        "int": f"CAST({key} * {position + 1} % 89 AS INT)",
        "date": f"date_add(DATE'1995-01-01', CAST({key} * {position + 1} % 1000 AS INT))",
        "key": f"2450400 + {key} * {position + 1} % 2000",
    }[kind]
    return _null_if(f"{key} % 31 = {position}", value)


class SuppliedTables:
    """Raw retail tables derived from the order tables in ``folder``; all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def raw(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _conform(
        self, name: str, df: DataFrame, prefix: str, columns: dict[str, str], key: str | None = None
    ) -> DataFrame:
        """Give ``df`` the full layout of a raw table.

        Columns without a formula are filled from ``key``, or typed nulls without one.
        """
        formulas = {f"{prefix}_{column}": formula for column, formula in columns.items()}
        selected = []
        for position, field in enumerate(RAW_SCHEMAS[name].fields):
            kind = "key" if is_key(field.name) else field.dataType.simpleString()
            blank = filler(kind, field.name, position, key) if key else f"CAST(NULL AS {field.dataType.simpleString()})"
            value = formulas.get(field.name, blank)
            selected.append(f"{f'CAST({value} AS BIGINT)' if is_key(field.name) else value} AS {field.name}")
        return df.selectExpr(*selected)

    @cached_property
    def _items(self) -> DataFrame:
        """Line items with exact price and calendar day."""
        return self.table("lineitem").selectExpr(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_returnflag",
            "CAST(l_discount AS DECIMAL(4,2)) AS discount",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS ext",
            "CAST(l_shipdate AS DATE) AS d",
        )

    @staticmethod
    def _copied(items: DataFrame) -> DataFrame:
        """Lines of items: those of odd orders have a second line of one piece."""
        return items.selectExpr("*", "explode(sequence(0, CAST(l_orderkey % 2 AS INT))) AS copy")

    @cached_property
    def _lines(self) -> DataFrame:
        return self._copied(self._items)

    def _met(self, items: DataFrame, other: DataFrame, key: str) -> DataFrame:
        """Items with their row of ``other``; two large tables meet in as many tasks as the items' files ask for."""
        tasks = wanted_tasks(self.table("lineitem")) if tasks_for(other) > 1 else None
        return dealt(items, [key], tasks).join(dealt(other, [key], tasks), key)

    @cached_property
    def _prices(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS l_partkey", "CAST(p_retailprice AS DECIMAL(10,2)) AS price"
        )

    def _sales(self, name: str, prefix: str, remainder: int) -> DataFrame:
        orders = self.table("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
        items = self._items.where(f"l_linenumber % 3 = {remainder}")
        lines = self._copied(self._met(self._met(items, orders, "l_orderkey"), self._prices, "l_partkey"))
        store = prefix == "ss"
        columns = {
            "sold_date_sk": _null_if("l_orderkey % 61 = 0", _day_key("d")),
            "item_sk": "l_partkey",
            "store_sk" if store else "warehouse_sk": _null_if("l_partkey % 59 = 0", "l_suppkey"),
            "customer_sk" if store else "bill_customer_sk": _null_if("l_orderkey % 53 = 0", "o_custkey"),
            "ticket_number" if store else "order_number": "l_orderkey + 3000000000",
            "promo_sk": _null_if("discount = 0", "CAST(discount * 100 AS INT)"),
            "quantity": "CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 41 = 0 THEN 0 "
            "WHEN copy = 1 THEN CAST(1 AS DECIMAL(10,0)) ELSE CAST(l_quantity AS DECIMAL(10,0)) END",
            "sales_price": "price",
            "ext_wholesale_cost": "ext * CAST(0.70 AS DECIMAL(4,2))",
            "net_profit": "ext * (CAST(0.30 AS DECIMAL(4,2)) - 5 * discount)",
        }
        if not store:
            columns["ship_date_sk"] = _null_if("l_partkey % 7 = 0", _day_key("date_add(d, 3)"))
        return self._conform(name, lines, prefix, columns)

    @cached_property
    def catalog_sales(self) -> DataFrame:
        return self._sales("catalog_sales", "cs", 1)

    @cached_property
    def web_sales(self) -> DataFrame:
        return self._sales("web_sales", "ws", 2)

    @cached_property
    def store_sales(self) -> DataFrame:
        return self._sales("store_sales", "ss", 0)

    def _returns(self, name: str, prefix: str, amount: str, remainder: int) -> DataFrame:
        lines = self._lines.where(f"l_linenumber % 3 = {remainder} AND l_returnflag = 'R' AND copy = 0").join(
            self._prices, "l_partkey"
        )
        half = "CAST(CAST(l_quantity AS INT) DIV 2 AS DECIMAL(10,0))"
        columns = {
            "returned_date_sk": _day_key("date_add(d, CAST(l_partkey % 20 AS INT))"),
            "item_sk": "l_partkey",
            "ticket_number" if prefix == "sr" else "order_number": "l_orderkey + 3000000000",
            "return_quantity": half,
            amount: f"{half} * price",
            "net_loss": "ext * CAST(0.10 AS DECIMAL(4,2))",
        }
        return self._conform(name, lines, prefix, columns)

    @cached_property
    def catalog_returns(self) -> DataFrame:
        return self._returns("catalog_returns", "cr", "return_amount", 1)

    @cached_property
    def web_returns(self) -> DataFrame:
        return self._returns("web_returns", "wr", "return_amt", 2)

    @cached_property
    def store_returns(self) -> DataFrame:
        return self._returns("store_returns", "sr", "return_amt", 0)

    @cached_property
    def inventory(self) -> DataFrame:
        sunday = "next_day(date_sub(d, 7), 'Sunday') AS w"
        weeks = self._items.selectExpr("l_partkey AS p", "l_suppkey AS s", sunday).distinct()
        weeks = weeks.selectExpr("*", "explode(IF((p + s) % 2 = 0, array(4, 2), array(4))) AS weekday")
        mix = "(p * 7 + s * 13)"
        on_hand = _null_if(f"{mix} % 17 = 0", f"({mix} + {_day_key('w')} + weekday) % 60")
        columns = {
            "date_sk": _day_key("date_add(w, weekday)"),
            "item_sk": "p",
            "warehouse_sk": "s",
            "quantity_on_hand": f"CAST({on_hand} AS DECIMAL(10,0))",
        }
        return self._conform("inventory", weeks, "inv", columns)

    @cached_property
    def date_dim(self) -> DataFrame:
        last = self._items.selectExpr("max(d) AS last")
        days = last.selectExpr("explode(sequence(DATE'1995-01-01', last)) AS day").where(f"{_day_key('day')} % 97 <> 0")
        columns = {
            "date_sk": _day_key("day"),
            "date": "day",
            "year": "year(day)",
            "moy": "month(day)",
            "dom": "day(day)",
            "qoy": "quarter(day)",
            "day_name": "date_format(day, 'EEEE')",
            "quarter_name": "year(day) || 'Q' || quarter(day)",
        }
        return self._conform("date_dim", days, "d", columns)

    @cached_property
    def item(self) -> DataFrame:
        columns = {
            "item_sk": "p_partkey",
            "item_id": "'I' || p_partkey",
            "product_name": "p_name",
            "brand": "p_brand",
            "class": "p_type",
            "size": "CAST(p_size AS STRING)",
            "current_price": "p_retailprice",
            "item_desc": """concat('  ', p_name, chr(10), '"quoted", ', chr(92), 'n ', p_partkey, chr(13), ' ')""",
            "formulation": "IF(p_partkey % 2 = 0, '', NULL)",
        }
        return self._conform("item", self.table("part"), "i", columns, "p_partkey")

    @cached_property
    def _places(self) -> DataFrame:
        nations = self.table("nation").withColumnRenamed("n_regionkey", "r_regionkey")
        return nations.join(self.table("region"), "r_regionkey").select("n_nationkey", "n_name", "r_name")

    @cached_property
    def warehouse(self) -> DataFrame:
        located = self.table("supplier").join(
            self._places.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey"
        )
        columns = {
            "warehouse_sk": "s_suppkey",
            "warehouse_name": "s_name",
            "city": "n_name",
            "country": "r_name",
        }
        return self._conform("warehouse", located, "w", columns, "s_suppkey")

    @cached_property
    def customer(self) -> DataFrame:
        columns = {
            "customer_sk": "c_custkey",
            "customer_id": "c_name",
            "current_addr_sk": "c_nationkey",
            "current_cdemo_sk": SEGMENT_KEY,
            "current_hdemo_sk": "c_custkey % 20",
        }
        return self._conform("customer", self.table("customer"), "c", columns, "c_custkey")

    @cached_property
    def customer_address(self) -> DataFrame:
        columns = {"address_sk": "n_nationkey", "city": "n_name", "country": "r_name"}
        return self._conform("customer_address", self._places, "ca", columns, "n_nationkey")

    @cached_property
    def customer_demographics(self) -> DataFrame:
        segments = self.table("customer").selectExpr(f"{SEGMENT_KEY} AS place", "c_mktsegment").distinct()
        columns = {"demo_sk": "place", "credit_rating": "c_mktsegment"}
        return self._conform("customer_demographics", segments, "cd", columns, "place")

    @cached_property
    def household_demographics(self) -> DataFrame:
        columns = {
            "demo_sk": "id",
            "income_band_sk": _null_if("id = 13", "id % 5"),
            "dep_count": "CAST(id % 7 AS INT)",
            "vehicle_count": "CAST(id % 4 AS INT)",
        }
        return self._conform("household_demographics", self.spark.range(20), "hd", columns, "id")

    @cached_property
    def income_band(self) -> DataFrame:
        columns = {
            "income_band_sk": "id",
            "lower_bound": "CAST(id * 10000 AS INT)",
            "upper_bound": "CAST(id * 10000 + 9999 AS INT)",
        }
        return self._conform("income_band", self.spark.range(5), "ib", columns)


class StoredTables:
    """Raw tables written once as Parquet: ``folder/<table>``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @classmethod
    def write(cls, supplied: SuppliedTables, folder: str) -> StoredTables:
        for name in RAW_SCHEMAS:
            supplied.raw(name).write.mode("overwrite").parquet(f"{folder}/{name}")
        return cls(supplied.spark, folder)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in RAW_SCHEMAS:
            raise AttributeError(name)
        return self.raw(name)
