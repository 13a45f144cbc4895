"""Raw exports, mart Parquet tables and their SQL names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.functions.curves import curve_key
from martloom.functions.ratios import decimals_to_double
from martloom.sources import storage
from martloom.sources.manifest import write_manifest
from martloom.sources.readers import CSV_FORMAT, escaped_lines
from martloom.sources.snapshots import snapshot_path

STAGING = "_staging"


def export_raw(
    df: DataFrame, zone: str, name: str, as_of: date, file_format: str = "csv", manifest: bool = False
) -> int:
    """Write one dated table and return its row count, counted while writing.

    The table is written aside and moved to its place when complete, so a failure
    leaves nothing that could be read, and an earlier export of that day in place.
    CSV keeps text as it is: blanks, quotes, empty text and null, and line breaks in
    an escaped form, so that files stay splittable.

    Args:
        manifest: list what each file holds (``sources.manifest``), which reads them once more.
    """
    spark = df.sparkSession
    target = snapshot_path(zone, name, as_of, file_format)
    staged = f"{zone.rstrip('/')}/{STAGING}/{target.rsplit('/', 1)[-1]}"
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    try:
        if file_format == "csv":
            counted = counted.select([escaped_lines(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])
            counted.write.mode("overwrite").option("header", True).options(**CSV_FORMAT).csv(staged)
        else:
            counted.write.mode("overwrite").format(file_format).save(staged)
        if manifest:
            write_manifest(spark, staged)
    except Exception:
        storage.delete(spark, staged)
        raise
    storage.replace(spark, staged, target)
    return written.get["rows"]


def clear_zone(spark: SparkSession, zone: str) -> None:
    """Empty the raw zone, older snapshots included."""
    for name in storage.children(spark, zone):
        storage.delete(spark, f"{zone.rstrip('/')}/{name}")


def write_mart(df: DataFrame, base: str, name: str, partition_by: Sequence[str] = ()) -> None:
    """Replace one mart table. Exact decimal measures are published as doubles.

    With ``partition_by`` rows meet by those columns first, in evenly sized tasks, so
    that a value's rows go to a few files and not one per task.
    """
    frame = decimals_to_double(df)
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    writer = frame.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{name}")


def publish(spark: SparkSession, base: str, names: Iterable[str], as_tables: bool = False) -> list[str]:
    """Make mart tables available to SQL as ``<name>_table``; no row is copied.

    Args:
        as_tables: catalog tables over the mart's files, which outlive the session;
            views otherwise. Publishing again replaces the entry, not the files.
    """
    published = []
    for name in names:
        table, path = f"{name}_table", f"{base}/{name}"
        if as_tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.catalog.createTable(table, path=path, source="parquet")
            if any("=" in child for child in storage.children(spark, path)):
                spark.catalog.recoverPartitions(table)
        else:
            spark.read.parquet(path).createOrReplaceTempView(table)
        published.append(table)
    return published


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Replace a catalog table that is stored by the hash of ``keys``, sorted by them.

    Rows meet by the keys once, here, one file per bucket. Later groupings by the keys, or by
    more columns beside them, and joins on the keys with a table of as many buckets
    read their buckets as they lie. As many buckets as tasks are wanted: at 128 MB each, a
    terabyte asks for 8,192.

    Args:
        path: folder of the table's files; the warehouse's own place for it by default.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_clustered(df: DataFrame, base: str, name: str, by: Mapping[str, Column], files: int) -> None:
    """Replace one mart table, its rows laid out so that filters on any of ``by`` skip most files.

    A sort order serves its first column alone. Here files are stretches of a curve through
    all columns (``functions.curves``), so each holds a small range of every one. The columns'
    limits are read from ``df`` first: pass a stored table.

    Args:
        by: whole numbers to cluster by, as expressions over ``df``, the first the finest.
        files: as many as should be written.
    """
    frame = decimals_to_double(df)
    key = curve_key(frame, by)
    clustered = frame.withColumn("_curve", key).repartitionByRange(files, "_curve").sortWithinPartitions("_curve")
    clustered.drop("_curve").write.mode("overwrite").parquet(f"{base}/{name}")
