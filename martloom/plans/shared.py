"""Frames that several reports read: written once to shared storage.

A written table survives the loss of executors, is pruned by column like any
other, and gives Spark real sizes to plan with. What ``materialize`` writes
belongs to the session: ``release_shared`` deletes it, at the latest when the
driver's interpreter ends. Needs a classic session.
"""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.sources import storage

_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; without it, one in the warehouse, which is shared as well."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted with the session's other tables."""
    path = f"{shared_folder(spark)}/martloom/{name}-{uuid4().hex}"
    _WRITTEN.append(path)
    return path


def release_shared(spark: SparkSession) -> None:
    """Delete what this session left in the shared folder; frames that read it are then of no use."""
    while _WRITTEN:
        storage.delete(spark, _WRITTEN.pop())


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release_shared(spark)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    return _written(df, shared_path(df.sparkSession, name))


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``materialize``, and the number of rows, counted while writing."""
    seen = Observation()
    table = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return table, seen.get["rows"]


@contextmanager
def shared(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for the length of a ``with`` block; the table is deleted after it."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    try:
        yield _written(df, path)
    finally:
        storage.delete(spark, path)
        _WRITTEN.remove(path)
