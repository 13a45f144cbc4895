"""Mart tables in versions: a reader never meets a table that is missing or half written.

A version's rows lie in a folder of their own, which is never written to again. A
small log file, created last and only if its number is free, makes it a version::

    <base>/<name>/_versions/0000000007.json
    <base>/<name>/data-<random>/...

Until then a failed or running write is invisible, and two writers get two numbers.
Frames are pinned to the folder of their version: later versions do not change them.
``expire`` removes old versions and what failed writes have left.

The log file must be created exclusively by the storage; HDFS and local disks do so. A
log file cut short by a crash does not count, and its number is passed over.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.ratios import decimals_to_double
from martloom.sources import storage

LOG = "_versions"
DATA = "data-"


@dataclass(frozen=True)
class Version:
    """One committed state of a table."""

    number: int
    folder: str
    rows: int
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    committed: str = ""
    note: Mapping[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "number": self.number,
                "folder": self.folder,
                "rows": self.rows,
                "schema": json.loads(self.schema.json()),
                "partition_by": list(self.partition_by),
                "committed": self.committed,
                "note": dict(self.note),
            }
        )

    @staticmethod
    def from_json(text: str) -> Version:
        read = json.loads(text)
        schema = T.StructType.fromJson(read["schema"])
        partition_by = tuple(read["partition_by"])
        return Version(read["number"], read["folder"], read["rows"], schema, partition_by, read["committed"], read["note"])


def _table(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _log_file(base: str, name: str, number: int) -> str:
    return f"{_table(base, name)}/{LOG}/{number:010d}.json"


def _numbers(spark: SparkSession, base: str, name: str) -> list[int]:
    found = storage.children(spark, f"{_table(base, name)}/{LOG}")
    return sorted(int(f.removesuffix(".json")) for f in found if f.endswith(".json") and f[:-5].isdigit())


def _entry(spark: SparkSession, base: str, name: str, number: int) -> Version | None:
    try:
        return Version.from_json(storage.read_text(spark, _log_file(base, name, number)))
    except (ValueError, KeyError):
        return None


def versions(spark: SparkSession, base: str, name: str) -> list[Version]:
    """The committed versions of a table, oldest first; none if there is no such table."""
    entries = (_entry(spark, base, name, n) for n in _numbers(spark, base, name))
    return [entry for entry in entries if entry is not None]


def is_versioned(spark: SparkSession, base: str, name: str) -> bool:
    return storage.exists(spark, f"{_table(base, name)}/{LOG}")


def find_version(spark: SparkSession, base: str, name: str, number: int | None = None) -> Version:
    """Version ``number``; by default the latest, negative numbers count from it (-1: the one before)."""
    if number is not None and number > 0:
        found = _entry(spark, base, name, number) if number in _numbers(spark, base, name) else None
    else:
        all_of_them = versions(spark, base, name)
        at = len(all_of_them) - 1 + (number or 0)
        found = all_of_them[at] if 0 <= at < len(all_of_them) else None
    if found is None:
        raise LookupError(f"{_table(base, name)} has no version {'at all' if number is None else number}")
    return found


def write_version(
    df: DataFrame,
    base: str,
    name: str,
    partition_by: Sequence[str] = (),
    note: Mapping[str, str] | None = None,
    exact: bool = False,
) -> Version:
    """Write ``df`` as the next version of a table.

    The version before stays what readers get until the new one is complete. A write
    that fails leaves no trace.

    Args:
        note: kept with the version.
        exact: keep decimals, which are published as doubles otherwise.
    """
    spark = df.sparkSession
    frame = df if exact else decimals_to_double(df)
    folder = f"{_table(base, name)}/{DATA}{uuid4().hex}"
    written = Observation()
    counted = frame.observe(written, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        counted = counted.hint("rebalance", *partition_by)
    writer = counted.write.partitionBy(*partition_by) if partition_by else counted.write
    try:
        writer.parquet(folder)
    except Exception:
        storage.delete(spark, folder)
        raise
    known = _numbers(spark, base, name)
    number = known[-1] + 1 if known else 1
    while True:
        now = datetime.now(UTC).isoformat(timespec="seconds")
        version = Version(number, folder, written.get["rows"], frame.schema, tuple(partition_by), now, note or {})
        if storage.write_new(spark, _log_file(base, name, number), version.to_json()):
            return version
        number += 1


def read_version(spark: SparkSession, base: str, name: str, number: int | None = None) -> DataFrame:
    """A version's rows, columns in the order in which they were written; see ``find_version`` for ``number``."""
    version = find_version(spark, base, name, number)
    return spark.read.schema(version.schema).parquet(version.folder).select(*[f"`{c}`" for c in version.schema.names])


def publish_versions(
    spark: SparkSession, base: str, names: Iterable[str], number: int | None = None, as_tables: bool = False
) -> list[str]:
    """Make versions available to SQL as ``<name>_table``; no row is copied.

    All versions are looked up before the first name is set, so a missing one changes
    nothing. A catalog table is pointed at the version's folder in one step if its
    columns are the same; otherwise it is made anew.
    """
    found = {name: find_version(spark, base, name, number) for name in names}
    for name, version in found.items():
        table = f"{name}_table"
        if not as_tables:
            read_version(spark, base, name, version.number).createOrReplaceTempView(table)
            continue
        same = spark.catalog.tableExists(table) and not version.partition_by
        if same and [(f.name, f.dataType) for f in spark.table(table).schema] == [
            (f.name, f.dataType) for f in version.schema
        ]:
            location = version.folder.replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            continue
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=version.folder, source="parquet")
        if version.partition_by:
            spark.catalog.recoverPartitions(table)
    return [f"{name}_table" for name in found]


def expire(
    spark: SparkSession, base: str, name: str, keep: int, failed_after: timedelta = timedelta(days=7)
) -> list[int]:
    """Remove all versions but the last ``keep``, and data that no version names for ``failed_after``.

    A version is taken out of the log first, so none is left whose data are gone. Frames
    pinned to a removed version can no longer be read. Returns the removed numbers.
    """
    if keep < 1:
        raise ValueError("the last version stays")
    known = versions(spark, base, name)
    removed = known[:-keep]
    for version in removed:
        storage.delete(spark, _log_file(base, name, version.number))
        storage.delete(spark, version.folder)
    # Looked up again: a writer may have committed meanwhile.
    named = {v.folder.rsplit("/", 1)[-1] for v in versions(spark, base, name)}
    for child in storage.children(spark, _table(base, name)):
        path = f"{_table(base, name)}/{child}"
        if child.startswith(DATA) and child not in named:
            if time.time() - storage.modified(spark, path) > failed_after.total_seconds():
                storage.delete(spark, path)
    return [v.number for v in removed]
