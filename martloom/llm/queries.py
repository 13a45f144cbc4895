"""One query per corpus operator, over the supplied tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    ann,
    bpe,
    chat,
    exact_dedup,
    langid,
    line_dedup,
    mixture,
    packing,
    prefix_trie,
    simhash,
    source_audit,
    substring_dedup,
    warc,
)
from martloom.llm.common import table
from martloom.plans.shared import shared_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_report(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_files(spark, f"{sf_dir}/documents.parquet")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).drop("url")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify_languages(docs, langid.train(docs.where(~langid.held_out())))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents"))


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixture.pack_mixture(docs, public_tokenizers.path("word_bpe_49k.json"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_line_dedup": op8_line_dedup,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_language_id": op10_language_id,
    "op11_source_divergence": op11_source_divergence,
    "op12_mixture_packing": op12_mixture_packing,
    "op13_prefix_trie": op13_prefix_trie,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": chat.ORACLE,
    "op5_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
        WINDOW same AS (PARTITION BY t)
    """,
    "op7_warc": """
        SELECT page_id, size AS payload_bytes, digest AS payload_digest,
               CASE WHEN size >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM (SELECT page_id, strlen(html) AS size, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS last
              FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
    """,
    "op11_source_divergence": source_audit.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
