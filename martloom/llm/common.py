"""Small helpers of the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.plans.shared import materialize

SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def numbered(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` (with a ``text``) with a unique, non-null long ``__row`` that orders rows by id.

    Where the ids are unique and set, ``__row`` is the id. Otherwise rows with
    repeated ids are separate documents, ordered by their text's hash; nulls come
    first. That numbering is written once, so that it is the same whenever a lost
    task is run again.
    """
    ids = docs.select(F.col(id_column).cast("long").alias("id"))
    odd = ids.groupBy("id").count().where("count > 1 OR id IS NULL").limit(1).count()
    if not odd:
        return docs.withColumn("__row", F.col(id_column).cast("long"))
    order = [F.col(id_column).asc_nulls_first(), F.xxhash64("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each; long values stay whole."""
    for batch in batches:
        values = batch.column(column)
        start = held = 0
        for i, size in enumerate(pc.binary_length(values).to_pylist()):
            if held and held + (size or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once in each Python worker and kept between its tasks."""
    store = sys.modules.setdefault("_martloom_kept", ModuleType("_martloom_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def forget() -> None:
    """Drop what other operators' tasks have kept in this Python worker, which the next operator's tasks use again."""
    store = sys.modules.get("_martloom_kept")
    if store is not None:
        for name in [n for n in store.__dict__ if not n.startswith("__")]:
            del store.__dict__[name]
    pa.default_memory_pool().release_unused()


def extended(schema: T.StructType, fields: str) -> T.StructType:
    """A new schema: the fields of ``schema``, then those of a DDL text."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(fields).fields])
