"""The daily extract: every table as known on a day, as dated CSV or another format."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from martloom.sinks import clear_zone, export_raw
from martloom.sources.snapshots import (
    CALENDAR_FIRST_DAY,
    CALENDAR_LAST_DAY,
    as_of_filter,
    as_of_key,
    calendar_range,
)

# A table, or how to open it: opening then fails for that table alone.
Source = DataFrame | Callable[[], DataFrame]

# Tables exported at the same time.
TABLES_AT_ONCE = 4

_REPORT = "table_name string, row_count long, status string, error string"


def _open(source: Source) -> DataFrame:
    return source if isinstance(source, DataFrame) else source()


def snapshot_rows(
    name: str,
    table: DataFrame,
    as_of_sk: int,
    first_day: date = CALENDAR_FIRST_DAY,
    last_day: date = CALENDAR_LAST_DAY,
) -> DataFrame:
    """Rows of one table that go into the snapshot; the calendar has its own day range."""
    return calendar_range(table, first_day, last_day) if name == "date_dim" else as_of_filter(table, as_of_sk)


def export_all(
    spark: SparkSession,
    tables: Mapping[str, Source],
    zone: str,
    as_of: date,
    as_of_sk: int,
    file_format: str = "csv",
    first_day: date = CALENDAR_FIRST_DAY,
    last_day: date = CALENDAR_LAST_DAY,
    manifest: bool = False,
) -> DataFrame:
    """Export the tables, a few at a time; one that fails is reported, leaves nothing behind, and the others go on.

    A table's last tasks and its file operations leave cores free, which the next tables use.
    """

    def export(name: str) -> tuple:
        try:
            table = snapshot_rows(name, _open(tables[name]), as_of_sk, first_day, last_day)
            return name, export_raw(table, zone, name, as_of, file_format, manifest), "exported", None
        except Exception as problem:  # any failure concerns this table alone
            return name, None, "failed", str(problem)

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        return spark.createDataFrame(list(pool.map(export, tables)), _REPORT)


def extract_snapshot(
    spark: SparkSession,
    tables: Mapping[str, Source],
    as_of: date,
    zone: str,
    keep_older: bool = False,
    file_format: str = "csv",
    first_day: date = CALENDAR_FIRST_DAY,
    last_day: date = CALENDAR_LAST_DAY,
    manifest: bool = False,
) -> DataFrame:
    """Write the snapshot of a day and report rows and status of each table.

    Args:
        tables: source tables by name, ``date_dim`` among them.
        as_of: the day; an error if the calendar lacks it, before anything is deleted.
        zone: folder that holds nothing but raw snapshots.
        keep_older: leave earlier snapshots in the zone instead of emptying it.
        file_format: ``csv``, or ``parquet``, from which readers take single columns.
        first_day, last_day: range of the exported calendar.
        manifest: list what each file holds, so that its wholeness can be verified later.
    """
    as_of_sk = as_of_key(_open(tables["date_dim"]), as_of)
    if not keep_older:
        clear_zone(spark, zone)
    return export_all(spark, tables, zone, as_of, as_of_sk, file_format, first_day, last_day, manifest)
