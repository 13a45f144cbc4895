"""What a written snapshot holds, file by file, and whether it still does.

That a write was committed does not tell whether its files are all there and whole
later on. A manifest lists each file of a table with its size, its rows and a digest of
their contents: sums of two 64-bit hashes, which do not depend on the order of rows. It is
made and verified by executors that read the files as tables, a large file in many parts;
no file is held whole anywhere.

The manifest lies in the table's own folder, under a name that readers pass over, so it
comes and goes with the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans.shared import materialize
from martloom.sources import storage

MANIFEST = "_manifest"
_SCHEMA = "file string, bytes long, rows long, sum_1 decimal(38,0), sum_2 decimal(38,0)"
STATUS = "table_name string, file string, status string, bytes long, rows long"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The contents of a table's files by row: lines of text files, all columns of others."""
    file_format = path.rstrip("/").rsplit(".", 1)[-1]
    if file_format in ("csv", "json", "txt"):
        return spark.read.text(path)
    return spark.read.format(file_format).load(path)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes, rows, sum_1, sum_2`` of every file of a table; files without rows are left out."""
    rows = _lines(spark, path)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    gaps = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    hashes = [F.xxhash64(*columns, gaps), F.xxhash64(F.lit("second"), gaps, *reversed(columns))]
    named = rows.select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        *[h.cast("decimal(20,0)").alias(f"h{i}") for i, h in enumerate(hashes, 1)],
    )
    return named.groupBy("file").agg(
        F.max("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(f"h{i}").cast("decimal(38,0)").alias(f"sum_{i}") for i in (1, 2)],
    )


def write_manifest(spark: SparkSession, path: str) -> None:
    """List what the files of a written table hold, in place of an earlier list."""
    target = f"{path.rstrip('/')}/{MANIFEST}"
    staged = f"{target}_new"
    digests(spark, path).coalesce(1).write.mode("overwrite").parquet(staged)
    storage.replace(spark, staged, target)


def _verified(spark: SparkSession, name: str, path: str) -> DataFrame:
    listed = f"{path.rstrip('/')}/{MANIFEST}"
    if not storage.exists(spark, listed):
        return spark.createDataFrame([(name, None, "no manifest", None, None)], STATUS)
    was = spark.read.schema(_SCHEMA).parquet(listed).alias("was")
    now = digests(spark, path).alias("now")
    equal = [F.col(f"was.{c}") == F.col(f"now.{c}") for c in ("bytes", "rows", "sum_1", "sum_2")]
    status = (
        F.when(F.col("now.file").isNull(), "missing")
        .when(F.col("was.file").isNull(), "not listed")
        .when(equal[0] & equal[1] & equal[2] & equal[3], "whole")
        .otherwise("changed")
    )
    return was.join(now, F.col("was.file") == F.col("now.file"), "full").select(
        F.lit(name).alias("table_name"),
        F.coalesce("was.file", "now.file").alias("file"),
        status.alias("status"),
        F.coalesce("now.bytes", "was.bytes").alias("bytes"),
        F.coalesce("now.rows", "was.rows").alias("rows"),
    )


def verify_snapshot(spark: SparkSession, paths: Mapping[str, str], names: Iterable[str] | None = None) -> DataFrame:
    """``table_name, file, status, bytes, rows`` of every file of a snapshot's tables.

    ``status``: ``whole``; ``changed`` in size or contents; ``missing``; ``not listed``, a file that
    came later; ``no manifest`` for a table without one. A file that cannot be read as its
    format any more, such as a cut Parquet file, fails the table's check: status ``unreadable``.
    """
    found = []
    for name in names or paths:
        try:
            found.append(materialize(_verified(spark, name, paths[name]), "verified_files"))
        except Exception as problem:  # what cannot be read concerns this table alone
            reason = f"unreadable: {str(problem).splitlines()[0][:200]}"
            found.append(spark.createDataFrame([(name, None, reason, None, None)], STATUS))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], STATUS)


def require_whole(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """An error that names all files of a snapshot that are not what was written."""
    lost = verify_snapshot(spark, paths).where("status <> 'whole'").orderBy("table_name", "file").collect()
    if lost:
        told = ", ".join(f"{r.table_name}{'/' + r.file if r.file else ''}: {r.status}" for r in lost)
        raise ValueError(f"the snapshot is not whole: {told}")
