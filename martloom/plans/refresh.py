"""Refresh of tables by day, the daily sales fact above all: only days whose lines changed are written again.

A table lies in partitions of a number of days, one by default. Every day of a snapshot has a digest that does not depend on the order of its lines:
their number, the sums of two 64-bit hashes of each line, and a hash of the day's
calendar attributes. Digests of the snapshot that the fact was built from are kept
beside it. Partitions of days whose digests differ are built again and replaced; those whose
days have no lines any more are deleted; all others stay as they are, file by file.

Partitions first, digests last: if a refresh stops in between, the next one finds the
same days, and writes them again. The digests are a versioned table, so a failed write
leaves those of the snapshot before. One refresh at a time: of two that run at once the
later one stops, unless it has begun to write.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.ratios import decimals_to_double
from martloom.operators import sales
from martloom.operators.order_states import order_states
from martloom.plans.shared import shared
from martloom.plans.sizing import MAX_CALENDAR_DAYS, broadcast_within
from martloom.sources import storage
from martloom.versions import expire, find_version, is_versioned, read_version, write_version

DAY = "sold_date_sk"
# Partition of a row: its day key by the number of days in a partition.
PART = "_days"
DAILY = "fact_sales_marketing_daily"
# Lines are told apart by all that a fact row is made of.
LINE_COLUMNS = (
    "customer_sk",
    "item_sk",
    "promo_sk",
    "order_number",
    "channel_key",
    "daily_qty",
    "daily_sales_amt",
    "daily_net_profit",
    "daily_cogs",
)
_ATTRIBUTES = ("date", "year", "month", "week_of_year")
_DIGEST = ("lines", "sum_1", "sum_2", "attributes")


def _nulls(columns: tuple[str, ...]) -> Column:
    """Which of ``columns`` are null, as a number; hashes pass nulls over."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)]
    return sum(bits[1:], bits[0])


def _exact_sum(column: str) -> Column:
    """Sum of 64-bit numbers whose upper and lower halves are summed as longs: exact up to 2 ** 31 lines a day."""
    upper, lower = F.sum(F.shiftright(column, 32)), F.sum(F.col(column).bitwiseAND(F.lit(0xFFFFFFFF)))
    return (upper.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + lower.cast("decimal(20,0)")).cast("decimal(38,0)")


def day_digests(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """``sold_date_sk, lines, sum_1, sum_2, attributes``: one digest per day of ``incremental_sales``.

    Equal for equal sets of lines in any order; a repeated line counts each time. Lines
    without a day, and days that the calendar does not know, have digests as well.
    """
    nulls = _nulls(LINE_COLUMNS)
    hashes = lines.select(
        DAY,
        F.xxhash64(*LINE_COLUMNS, nulls).alias("h1"),
        F.xxhash64(F.lit("second"), *reversed(LINE_COLUMNS), nulls).alias("h2"),
    )
    per_day = hashes.groupBy(DAY).agg(
        F.count(F.lit(1)).alias("lines"),
        _exact_sum("h1").alias("sum_1"),
        _exact_sum("h2").alias("sum_2"),
    )
    attributes = F.xxhash64(*_ATTRIBUTES, _nulls(_ATTRIBUTES)).alias("attributes")
    days = calendar.select(F.col("date_sk").alias(DAY), attributes)
    return per_day.join(days, DAY, "left").select(DAY, *_DIGEST)


def touched_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """``sold_date_sk, change`` of days whose digests differ: ``added``, ``changed`` or ``removed``."""
    was, now = before.alias("was"), after.alias("now")
    same_day = F.col(f"was.{DAY}").eqNullSafe(F.col(f"now.{DAY}"))
    change = (
        F.when(F.col("was.lines").isNull(), F.lit("added"))
        .when(F.col("now.lines").isNull(), F.lit("removed"))
        .when(~_all_equal(), F.lit("changed"))
    )
    joined = was.join(now, same_day, "full")
    return joined.select(F.coalesce(f"now.{DAY}", f"was.{DAY}").alias(DAY), change.alias("change")).where("change IS NOT NULL")


def _all_equal() -> Column:
    equal = [F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}")) for c in _DIGEST]
    return equal[0] & equal[1] & equal[2] & equal[3]


@dataclass(frozen=True)
class Refreshed:
    """How many days of a table came, changed and went, how many there are, and partitions written and deleted."""

    added: int
    changed: int
    removed: int
    days: int
    written: int = 0
    deleted: int = 0


def _folder(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _partition(base: str, name: str, part: int | None) -> str:
    return f"{_folder(base, name)}/{PART}={'__HIVE_DEFAULT_PARTITION__' if part is None else part}"


def _part(partition_days: int) -> Column:
    return F.floor(F.col(DAY) / partition_days).cast("long").alias(PART)


def published_fact(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """``fact_sales_daily`` as marts publish it."""
    return decimals_to_double(sales.fact_sales_daily(lines, calendar))


def dated_order_states(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """``order_states`` of ``incremental_sales``."""
    return order_states(sales.sales_with_date(lines, calendar))


def refresh_daily(
    lines: DataFrame,
    calendar: DataFrame,
    base: str,
    name: str = DAILY,
    build: Callable[[DataFrame, DataFrame], DataFrame] = published_fact,
    partition_days: int = 1,
) -> Refreshed:
    """Bring a table by day under ``base`` to the state of ``lines``; the first call builds it.

    The table is stored in plain Parquet; ``read_daily`` gives its usual columns. ``lines``
    are read twice, the second time for the touched partitions alone: pass a stored table.
    What is found without digests, such as the start of a first build that failed, or in
    partitions of another size, is thrown away.

    Args:
        lines: ``incremental_sales`` of the whole snapshot.
        calendar: ``week_calendar``, one row per day.
        build: the rows of some days from their lines and the calendar, each with its
            ``sold_date_sk``; the daily fact, or ``dated_order_states``.
        partition_days: days in a partition. More make fewer files of a small table, and
            write more of it again for a day that changed.
    """
    spark = lines.sparkSession
    kept = f"{base.rstrip('/')}/_digests"
    seen = find_version(spark, kept, name) if is_versioned(spark, kept, name) else None
    known = seen is not None and seen.note["partition_days"] == str(partition_days)
    part = _part(partition_days)
    with shared(day_digests(lines, calendar), "day_digests") as after:
        if known:
            before = read_version(spark, kept, name, seen.number)
        else:
            storage.delete(spark, _folder(base, name))
            before = after.limit(0)
        with shared(touched_days(before, after), "touched_days") as touched:
            counts = {r["change"]: r["count"] for r in touched.groupBy("change").count().collect()}
            days = after.count()
            if known and not counts:
                return Refreshed(0, 0, 0, days)
            parts = touched.select(part).distinct()
            rows = build(_lines_of(lines, parts, part), calendar)
            if seen is not None and find_version(spark, kept, name).number != seen.number:
                raise RuntimeError(f"another refresh of {_folder(base, name)} has come first")
            stored = rows.withColumn(PART, part).hint("rebalance", PART)
            writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(PART).parquet(_folder(base, name))
            # As many as there are folders to delete.
            left = after.select(part.alias("left")).distinct()
            gone = parts.join(left, F.col(PART).eqNullSafe(F.col("left")), "left_anti").collect()
            for row in gone:
                storage.delete(spark, _partition(base, name, row[PART]))
            written = parts.count() - len(gone)
        note = {"schema": rows.schema.json(), "partition_days": str(partition_days)}
        write_version(after, kept, name, note=note, exact=True)
        expire(spark, kept, name, keep=2)
    return Refreshed(
        counts.get("added", 0), counts.get("changed", 0), counts.get("removed", 0), days, written, len(gone)
    )


def _lines_of(lines: DataFrame, parts: DataFrame, part: Column) -> DataFrame:
    """Lines of touched partitions, those without a day among them."""
    small = broadcast_within(parts.select(F.col(PART).alias("_touched")), MAX_CALENDAR_DAYS)
    return lines.join(small, part.eqNullSafe(F.col("_touched")), "left_semi")


def read_daily(spark: SparkSession, base: str, name: str = DAILY) -> DataFrame:
    """A refreshed table in the column order in which it was built."""
    note = find_version(spark, f"{base.rstrip('/')}/_digests", name).note
    schema = T.StructType.fromJson(json.loads(note["schema"]))
    stored = T.StructType([*schema.fields, T.StructField(PART, T.LongType())])
    return spark.read.schema(stored).parquet(_folder(base, name)).select(*schema.names)
