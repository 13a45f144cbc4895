"""Raw CSV, mart Parquet and JDBC readers."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.schemas import RAW_SCHEMAS, is_key


# How CSV files of the raw zone are written and read. Nothing is trimmed.
CSV_FORMAT = {
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Line breaks within text, the backslash that marks them, and empty text, which a bare cell cannot tell
# from null.
_EMPTY = "\\e"
_LINE_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def escaped_lines(column: str) -> Column:
    """Text on one line and never empty; ``plain_lines`` turns it back."""
    text = F.col(f"`{column}`")
    for plain, escaped in _LINE_ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.when(text == "", F.lit(_EMPTY)).otherwise(text).alias(column)


def plain_lines(column: str) -> Column:
    """Text as it was before ``escaped_lines``."""
    text = F.col(f"`{column}`")
    for plain, escaped in reversed(_LINE_ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return F.when(F.col(f"`{column}`") == _EMPTY, F.lit("")).otherwise(text).alias(column)


def whole_number(column: str) -> str:
    """SQL for a key read as text: ``3000000000``, ``7`` and ``7.0`` are keys, fractions and other text are null."""
    exact = f"TRY_CAST({column} AS DECIMAL(38,6))"
    return f"IF({exact} = floor({exact}), TRY_CAST({exact} AS BIGINT), NULL) AS {column}"


def read_raw(
    spark: SparkSession, name: str, path: str | list[str], file_format: str = "csv", escaped: bool = True
) -> DataFrame:
    """Read one raw table from CSV with a header, or from another format.

    Cells that do not parse become null. A header that disagrees with the layout
    is an error rather than a silent shift of columns. Keys become longs here,
    once, so later joins and groupings compare whole numbers; they are read as
    text, whatever type the layout gives them, so that none is out of range.

    Args:
        escaped: whether line breaks in text are escaped as ``export_raw`` does.
    """
    if file_format != "csv":
        stored = spark.read.format(file_format).load(path)
        return stored.selectExpr(*[whole_number(c) if is_key(c) else c for c in RAW_SCHEMAS[name].names])
    fields = RAW_SCHEMAS[name].fields
    read_as = T.StructType([T.StructField(f.name, T.StringType() if is_key(f.name) else f.dataType) for f in fields])
    raw = (
        spark.read.schema(read_as)
        .option("header", True)
        .option("enforceSchema", False)
        .options(**CSV_FORMAT)
        .csv(path)
    )
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType) and not is_key(f.name)]
    if escaped:
        raw = raw.withColumns({c: plain_lines(c) for c in texts})
    return raw.selectExpr(*[whole_number(c) if is_key(c) else c for c in raw.columns])


def load_snapshot(
    spark: SparkSession, paths: Mapping[str, str], names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Lazy readers of the tables of a resolved snapshot; the format is the ending of a path."""
    return {
        name: read_raw(spark, name, paths[name], paths[name].rstrip("/").rsplit(".", 1)[-1])
        for name in (names or paths)
    }


def null_report(df: DataFrame) -> DataFrame:
    """Rows and nulls of every column, to see what a permissive load dropped."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    )
    per_column = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"null_{c}").alias("nulls")) for c in df.columns
    ]
    return counted.select(F.inline(F.array(*per_column)))


def read_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one mart table."""
    return spark.read.parquet(f"{base}/{name}")


# Spark settings, or environment variables, that hold the database's user, password and driver class.
JDBC_SETTINGS = {
    "user": ("spark.martloom.jdbc.user", "MARTLOOM_JDBC_USER"),
    "password": ("spark.martloom.jdbc.password", "MARTLOOM_JDBC_PASSWORD"),
    "driver": ("spark.martloom.jdbc.driver", "MARTLOOM_JDBC_DRIVER"),
}


def jdbc_access(spark: SparkSession) -> dict[str, str]:
    """User, password and driver as far as they are set; never part of the URL or the command line."""
    found = {}
    for option, (setting, variable) in JDBC_SETTINGS.items():
        value = spark.conf.get(setting, None) or os.environ.get(variable)
        if value:
            found[option] = value
    return found


def jdbc_options(
    url: str,
    table: str,
    predicate: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    access: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read that is split into ranges of ``partition_column``.

    The bounds only place the splits; rows outside them, and nulls, are still read.
    """
    source = f"(SELECT * FROM {table} WHERE {predicate}) AS extract_source" if predicate else table
    options = {"url": url, "dbtable": source, "fetchsize": str(fetch_size), **(access or {})}
    if partition_column is not None:
        split = {"lowerBound": lower_bound, "upperBound": upper_bound, "numPartitions": num_partitions}
        unset = [name for name, value in split.items() if value is None]
        if unset:
            raise ValueError(f"a partitioned JDBC read of {table} also needs {', '.join(unset)}")
        options["partitionColumn"] = partition_column
        options.update({name: str(value) for name, value in split.items()})
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **how) -> DataFrame:
    """Read a database table on the executors; see ``jdbc_options`` and ``jdbc_access``.

    Filters put on the result, such as ``as_of_filter``, are pushed into the database.
    """
    return spark.read.format("jdbc").options(**jdbc_options(url, table, access=jdbc_access(spark), **how)).load()


def base_tables_query(database: str) -> str:
    """Query for the names of a schema's base tables, views left out."""
    literal = database.replace("'", "''")
    return (
        "(SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = '{literal}' AND table_type = 'BASE TABLE') AS listed"
    )


def list_jdbc_tables(spark: SparkSession, url: str, database: str) -> list[str]:
    """All base tables of a database's schema, whether this package knows them or not."""
    return sorted(r[0] for r in read_jdbc(spark, url, base_tables_query(database)).collect())


# First key of the tables whose rows have one that is never null.
_PRIMARY_KEYS = (
    "c_customer_sk",
    "ca_address_sk",
    "cd_demo_sk",
    "cr_item_sk",
    "cs_item_sk",
    "d_date_sk",
    "hd_demo_sk",
    "i_item_sk",
    "ib_income_band_sk",
    "inv_date_sk",
    "sr_item_sk",
    "ss_item_sk",
    "w_warehouse_sk",
    "wr_item_sk",
    "ws_item_sk",
)


def split_column(columns: Sequence[str]) -> str | None:
    """Column to split a table's read by: a key that is never null if it is known, else its first key.

    Nulls of a split column all go into one range, so a nullable day key would put
    its null rows in one task.
    """
    keys = [c for c in columns if c.endswith("_sk")]
    return next((c for c in columns if c in _PRIMARY_KEYS), next(iter(keys), None))


def read_jdbc_split(
    spark: SparkSession, url: str, table: str, max_partitions: int, rows_per_partition: int = 1_000_000
) -> DataFrame:
    """Read a database table in ranges of one of its keys.

    The database is asked for the range of the key and the number of rows first;
    a range is to hold ``rows_per_partition`` rows, within ``max_partitions``. A
    table without a key, or without rows, is read in one piece.
    """
    column = split_column(read_jdbc(spark, url, table).columns)
    if column is None:
        return read_jdbc(spark, url, table)
    bounds = f"(SELECT min({column}) AS low, max({column}) AS high, count(*) AS n FROM {table}) AS key_range"
    low, high, rows = read_jdbc(spark, url, bounds).first()
    if low is None:
        return read_jdbc(spark, url, table)
    return read_jdbc(
        spark,
        url,
        table,
        partition_column=column,
        lower_bound=int(low),
        upper_bound=int(high) + 1,
        num_partitions=min(max_partitions, max(1, -(-int(rows) // rows_per_partition))),
    )
