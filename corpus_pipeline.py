"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns the next one's documents; the
last returns packed pieces. ``run`` writes every stage to the shared folder, so a
lost executor costs the stage at hand at most.

SQL cannot express the language model or the fingerprints, so there is no ORACLE_SQL;
the stages are tested against plain versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import langid, line_dedup, packing, simhash, substring_dedup
from martloom.llm.common import table
from martloom.plans.shared import materialize

ORACLE_SQL = None


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, characters counted anew."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; those without a letter, or without text, go."""
    model = langid.train(docs.where(~langid.held_out()))
    return langid.keep_identified(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has are cut out of the later ones."""
    return _counted(line_dedup.line_dedup(docs), docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near_copies(docs)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by strings of 100 bytes that occur earlier are cut out."""
    return _counted(substring_dedup.substring_dedup(docs, in_text=True), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, placed in as few sequences as can be."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("suffix_array_dedup", dedup_substrings),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
