"""As-of snapshots: which rows belong to a day, which files belong to a snapshot."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.schemas import RAW_SCHEMAS
from martloom.sources import storage

# A day key whose name has one of these parts must be set.
REQUIRED_DATE_PARTS = ("sold", "open", "start", "creation", "return")
# Day range of the exported calendar, both ends included.
CALENDAR_FIRST_DAY = date(1990, 1, 1)
CALENDAR_LAST_DAY = date(2030, 1, 1)

# What LIKE '%_date_sk' accepts: its underscores stand for any one character.
_DATE_KEY = re.compile(r".date.sk\Z", re.DOTALL)
_SNAPSHOT = re.compile(r"(?P<table>.+)_(?P<day>\d{4}-\d{2}-\d{2})\Z")


def date_key_columns(df: DataFrame) -> list[str]:
    """Columns that hold a day key."""
    return [c for c in df.columns if _DATE_KEY.search(c)]


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Base tables of a database; views are left out.

    Works for the session catalog and for a JDBC catalog configured on the cluster.
    """
    tables = spark.catalog.listTables(database)
    return sorted(t.name for t in tables if not t.isTemporary and t.tableType != "VIEW")


def _known_by(column: str, as_of_sk: int) -> Column:
    key = F.col(column)
    on_time = key <= as_of_sk
    if any(part in column.lower() for part in REQUIRED_DATE_PARTS):
        return on_time  # a comparison is never true for null
    return key.isNull() | on_time


def as_of_filter(df: DataFrame, as_of_sk: int, date_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows known on a day: no day key may lie after it, required ones must be set.

    A table without day keys is returned as it is.

    Args:
        as_of_sk: calendar key of the day.
        date_cols: day keys to test; found by name when not given.
    """
    columns = date_key_columns(df) if date_cols is None else list(date_cols)
    return df.where(reduce(and_, [_known_by(c, as_of_sk) for c in columns])) if columns else df


def as_of_day(date_dim: DataFrame, day: date) -> DataFrame:
    """Calendar key of a day, as a frame of one row (none if the calendar lacks it)."""
    return date_dim.where(F.col("d_date") == F.lit(day)).select("d_date_sk")


def as_of_key(date_dim: DataFrame, day: date) -> int:
    """Calendar key of a day; an error if the calendar has none. Runs a small job."""
    found = as_of_day(date_dim, day).first()
    if found is None:
        raise ValueError(f"the calendar has no key for {day}")
    try:
        return int(found[0])
    except (TypeError, ValueError):
        raise TypeError(f"the calendar key of {day} is not a whole number: {found[0]!r}") from None


def calendar_range(
    date_dim: DataFrame, first: date = CALENDAR_FIRST_DAY, last: date = CALENDAR_LAST_DAY
) -> DataFrame:
    """Calendar days between two days, both included."""
    return date_dim.where(F.col("d_date").between(F.lit(first), F.lit(last)))


def snapshot_path(zone: str, name: str, as_of: date, file_format: str = "csv") -> str:
    """Where a table of a day's snapshot is written."""
    return f"{zone.rstrip('/')}/{name}_{as_of.isoformat()}.{file_format}"


def expected_paths(zone: str, as_of: date, names: Iterable[str] = RAW_SCHEMAS, file_format: str = "csv") -> list[str]:
    """Paths of a complete snapshot, whether they are there or not."""
    return [snapshot_path(zone, name, as_of, file_format) for name in names]


def find_snapshot(
    spark: SparkSession, zone: str, required: Iterable[str] = RAW_SCHEMAS, as_of: date | None = None
) -> dict[str, str]:
    """Paths of the tables of a snapshot that are in the zone, each a completed write.

    An error names all required tables that are missing or unfinished; see
    ``resolve_snapshot``.
    """
    zone = zone.rstrip("/")
    names = [n for n in storage.children(spark, zone) if _SNAPSHOT.match(n.split(".")[0])]
    complete = [f"{zone}/{n}" for n in names if storage.is_complete(spark, f"{zone}/{n}")]
    return resolve_snapshot(complete, required, as_of)


def resolve_snapshot(
    paths: Iterable[str], required: Iterable[str] = RAW_SCHEMAS, as_of: date | None = None
) -> dict[str, str]:
    """Map table names to the paths of a snapshot.

    Args:
        paths: files or folders named ``<table>_<YYYY-MM-DD>.csv``.
        required: tables that must be there; an error names all that are missing.
        as_of: day of the snapshot; the latest of each table when not given.
    """
    newest: dict[str, tuple[str, str]] = {}
    for path in paths:
        stem = path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
        match = _SNAPSHOT.match(stem)
        if match is None or (as_of is not None and match["day"] != as_of.isoformat()):
            continue
        table, found = match["table"], (match["day"], path)
        newest[table] = max(newest.get(table, found), found)
    missing = sorted(set(required) - set(newest))
    if missing:
        raise ValueError(f"snapshot lacks required tables: {', '.join(missing)}")
    return {table: path for table, (_, path) in newest.items()}
