"""Exact deduplication as a stateful stream.

A stream over the documents keeps one state entry per digest of the normalised
text, in the disk-backed state store and without expiry. An entry holds the
digest, the number of rows seen, the stable identifier of the row that stays and
the locator of that row's content, by which its bytes are found again. Counts
are combined before the shuffle, so a group of copies, however large, sends one
row per task to its entry.

Answers come from the entries. Those of digests that were hit more than once are checked
on full bytes first: the rows of a digest are grouped by the text itself, and the entry
stands if there is one text and the row that its locator names has it. Only where a digest
turns out to stand for several texts, or its locator leads nowhere, are the answers
counted anew, text by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import text_or_empty
from martloom.plans.shared import materialize, shared_path

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """``text`` with A to Z lower-cased and all else unchanged."""
    one_byte_each = F.octet_length(text) == F.char_length(text)
    return F.when(one_byte_each, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def stream_state(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    bytes_per_batch: int = 64 << 30,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Run the stream over all Parquet files of ``path`` to its end and return its state.

    Started again with the same ``checkpoint`` it reads only files that came in
    since; after a failure it goes on from the last committed batch.

    Columns ``_digest, _seen, _stays, _content``: rows of a digest, the largest id
    and the locator (name of the file that holds that row).
    """
    path = path.rstrip("/")
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKS_DB,
        # Else each of the many small stores reserves megabytes for logs that stay nearly empty.
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        # As a pattern, the path may name one file as well as a folder.
        pattern = f"{path[:-1]}[{path[-1]}]"
        source = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(pattern)
        located = source.withColumn("_file", F.col("_metadata.file_path"))
        seen = _digests(located, id_column, text_column, digest, "_file").groupBy("_digest").agg(
            F.count(F.lit(1)).alias("_seen"),
            F.max("doc_id").alias("_stays"),
            F.max_by("_file", "doc_id").alias("_content"),
        )
        query = (
            seen.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.format("statestore").load(checkpoint)


def _digests(
    docs: DataFrame, id_column: str, text_column: str, digest: Callable[[Column], Column], *more: str | Column
) -> DataFrame:
    normal = ascii_lower(text_or_empty(text_column))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), digest(normal).alias("_digest"), *more)


def exact_dedup(
    docs: DataFrame,
    state: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``, files as read by Spark, from the state of a stream over them.

    Columns ``doc_id, keep_id, group_size, kept, text_sha256``. A null text is
    empty. The row with the largest id stays; null ids rank below all others and
    stay only where a group has no other id. Rows that repeat an id and a text are
    copies of each other, each with its own row and the same answer. Other columns
    are not read; an empty table has no rows.

    Args:
        digest: the state's key; texts that share one are told apart by their bytes.
    """
    entries = state.select("key._digest", "value.*").toDF(
        "_digest", "_seen", "_stays", "_content", "_content_of"
    )
    normal = ascii_lower(text_or_empty(text_column))
    hits = entries.where("_seen > 1").select("_digest", "_stays", "_content")
    # Full bytes: one row per digest and text; copies meet before the shuffle.
    file = F.col("_metadata.file_path").alias("_file")
    texts = materialize(
        _digests(docs, id_column, text_column, digest, normal.alias("_text"), file)
        .join(hits.select("_digest"), "_digest", "left_semi")
        .groupBy("_digest", "_text")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max("doc_id").alias("_largest"),
            F.max_by("_file", "doc_id").alias("_in"),
        )
        .select("_digest", _told_apart(F.col("_text")).alias("_second"), "_n", "_largest", "_in"),
        "repeated_texts",
    )
    there = F.col("_largest").eqNullSafe(F.col("_stays")) & F.col("_in").eqNullSafe(F.col("_content"))
    stands = texts.join(hits, "_digest").groupBy("_digest").agg((F.count(F.lit(1)) == 1).alias("_one"), F.max(there).alias("_there"))
    refuted = stands.where("NOT (_one AND _there)").select("_digest")
    anew = texts.join(refuted, "_digest", "left_semi").select(
        "_digest", "_second", F.col("_n").alias("_seen"), F.col("_largest").alias("_stays")
    )
    trusted = entries.join(refuted, "_digest", "left_anti").select(
        "_digest", F.lit(None).cast("string").alias("_second"), "_seen", "_stays"
    )
    rows = _digests(docs, id_column, text_column, digest, _told_apart(normal).alias("_own"), sha256(normal).alias("_sha"))
    joined = rows.join(trusted.unionByName(anew), "_digest").where("_second IS NULL OR _second = _own")
    return joined.select(
        "doc_id",
        F.col("_stays").alias("keep_id"),
        F.col("_seen").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("_stays")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def _told_apart(text: Column) -> Column:
    """What tells the texts of one digest apart: two further digests."""
    return F.concat(F.md5(text), F.sha1(text))


def dedup_files(spark: SparkSession, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``exact_dedup`` of the Parquet files of ``path``, state and all."""
    docs = spark.read.parquet(path)
    state = stream_state(
        spark, path, docs.schema, shared_path(spark, "exact_dedup"), id_column, text_column
    )
    return exact_dedup(docs, state, id_column, text_column)
