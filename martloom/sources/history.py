"""The history of a raw table: what changed from one dated snapshot to the next.

A snapshot a day is a copy of the table a day. The history keeps a row once, with the day
from which it was there and, when it is gone, the day from which it was not. ``record`` adds
a day's snapshot: it compares contents by 128-bit hashes, so only hashes travel, and writes
the rows that are new and the hashes of those that are gone. ``as_of`` reads the table of any
day; days between snapshots show the one before.

Raw tables have no key that could be relied on, so a row that changes is one gone and one
new. Rows that repeat are one row with a number of copies, and another number is a change.
Every day is a version (``martloom.versions``): a failed ``record`` leaves the history as
it was, and readers are never in its way.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.plans.shared import shared
from martloom.versions import Version, versions, write_version

ID, COPIES, FROM, TO = "_id", "_copies", "_from", "_to"


def _hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_id``, 128 bits that tell contents apart; null is not empty, nor the next column's value."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    if any(c in (ID, COPIES, FROM, TO) for c in rows.columns):
        raise ValueError(f"the names {ID}, {COPIES}, {FROM} and {TO} are taken")
    gaps = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    halves = [F.xxhash64(*columns, gaps), F.xxhash64(F.lit("second"), gaps, *reversed(columns))]
    return rows.withColumn(ID, F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def days(spark: SparkSession, base: str, name: str) -> list[date]:
    """Days whose snapshots are in the history, earliest first."""
    return [date.fromisoformat(v.note["day"]) for v in versions(spark, base, name)]


def record(snapshot: DataFrame, base: str, name: str, day: date) -> Version:
    """Add a day's snapshot to the history of a table; days are added in order.

    The snapshot is read twice: for its hashes, and for the rows that are new. Its columns
    must be those of the snapshots before.
    """
    spark = snapshot.sparkSession
    known = days(spark, base, name)
    if known and day <= known[-1]:
        raise ValueError(f"the history of {name} reaches to {known[-1]}, {day} cannot be added")
    if known and snapshot.columns != _columns(versions(spark, base, name)[-1].schema):
        raise ValueError(f"the history of {name} has other columns")
    hashed = _hashed(snapshot)
    there = hashed.groupBy(ID).agg(F.count(F.lit(1)).alias(COPIES))
    before = _open_ids(spark, base, name, day)
    same = F.col("n._id").eqNullSafe(F.col("o._id")) & (F.col("n._copies") == F.col("o._copies"))
    differ = there.alias("n").join(before.alias("o"), same, "full").where("n._id IS NULL OR o._id IS NULL")
    with shared(differ.selectExpr("n._id AS new", "n._copies AS copies", "o._id AS gone", "o._from AS since"), "changed_rows") as changed:
        opened = changed.where("new IS NOT NULL").select(F.col("new").alias(ID), F.col("copies").alias(COPIES))
        kept = hashed.join(opened, ID).dropDuplicates([ID])
        wide = kept.select(
            *[F.col(f"`{c}`") for c in snapshot.columns],
            ID,
            COPIES,
            F.lit(day).alias(FROM),
            F.lit(None).cast("date").alias(TO),
        )
        closed = changed.where("gone IS NOT NULL").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in snapshot.schema.fields],
            F.col("gone").alias(ID),
            F.lit(None).cast("long").alias(COPIES),
            F.col("since").alias(FROM),
            F.lit(day).alias(TO),
        )
        return write_version(wide.unionByName(closed), base, name, note={"day": day.isoformat()}, exact=True)


def _columns(schema: T.StructType) -> list[str]:
    return [n for n in schema.names if n not in (ID, COPIES, FROM, TO)]


def _changes(spark: SparkSession, base: str, name: str, day: date | None) -> DataFrame | None:
    """All that was written up to a day, in the columns of the latest version read; none before the first."""
    read = [v for v in versions(spark, base, name) if day is None or date.fromisoformat(v.note["day"]) <= day]
    if not read:
        return None
    schema = read[-1].schema
    return spark.read.schema(schema).parquet(*[v.folder for v in read]).select(*[f"`{c}`" for c in schema.names])


def _open(changes: DataFrame) -> DataFrame:
    """Rows that came and have not gone, as far as ``changes`` reach."""
    gone = changes.where(F.col(TO).isNotNull()).select(ID, FROM)
    return changes.where(F.col(TO).isNull()).join(gone, [ID, FROM], "left_anti")


def _open_ids(spark: SparkSession, base: str, name: str, day: date) -> DataFrame:
    changes = _changes(spark, base, name, day)
    if changes is None:
        return spark.createDataFrame([], f"{ID} string, {COPIES} long, {FROM} date")
    return _open(changes.select(ID, COPIES, FROM, TO)).select(ID, COPIES, FROM)


def as_of(spark: SparkSession, base: str, name: str, day: date) -> DataFrame:
    """The table as its last snapshot up to ``day`` had it; an error for days before the first."""
    changes = _changes(spark, base, name, day)
    if changes is None:
        raise LookupError(f"the history of {name} does not reach back to {day}")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))
    kept = _columns(changes.schema)
    rows = _open(changes)
    repeated = rows.where(F.col(COPIES) > 1).select(*[f"`{c}`" for c in kept], copies.alias(ID)).drop(ID)
    return rows.where(F.col(COPIES) == 1).select(*[f"`{c}`" for c in kept]).unionByName(repeated)


def intervals(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Every row with ``_copies`` and the days between which it was there: ``_from``, and ``_to`` (null: still)."""
    changes = _changes(spark, base, name, None)
    if changes is None:
        raise LookupError(f"{name} has no history")
    gone = changes.where(F.col(TO).isNotNull()).select(ID, FROM, TO)
    came = changes.where(F.col(TO).isNull()).drop(TO)
    return came.join(gone, [ID, FROM], "left").select(*[f"`{c}`" for c in _columns(changes.schema)], COPIES, FROM, TO)
