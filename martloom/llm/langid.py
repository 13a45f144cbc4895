"""Language identification by string kernels.

The kernel of two texts is the blended-spectrum presence kernel: the number of
n-grams (n = 1 to 4, bytes of the lower-cased text, folded into ``BINS`` bins)
that occur in both, over the geometric mean of how many occur in each. Landmark
texts span a Nyström feature space, in which one ridge regression per language
is fitted against all others. As the kernel is linear in the presence vectors,
landmarks and weights fold into one matrix of bins by languages, and batches of
texts are scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import SLICE_BYTES, extended, forget, slices

ORDERS = (1, 2, 3, 4)
BINS = 1 << 16
# Bounds of what is learned from: rows per language, landmarks in all, weight of the ridge.
SAMPLE_PER_LANGUAGE = 400
LANDMARKS = 256
RIDGE = 1e-2
UNKNOWN = "und"
ROWS_PER_PRODUCT = 32
# Rows learned from in all, 8 KB each on the driver; with very many languages each gets fewer, one at least.
SAMPLE_ROWS = 20_000
# Bytes of a text whose n-grams are taken at a time.
PART_BYTES = 1 << 20


def presence(text: str) -> Iterator[np.ndarray]:
    """Bins of the text's n-grams, repeats included, part by part; parts overlap by what an n-gram needs."""
    whole = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    for start in range(0, len(whole), PART_BYTES):
        octets = whole[start : start + PART_BYTES + max(ORDERS) - 1].astype(np.uint64)
        gram = np.zeros(len(octets), dtype=np.uint64)
        for n in ORDERS:
            if len(octets) < n:
                break
            gram = (gram[: len(octets) - n + 1] << np.uint64(8)) | octets[n - 1 :]
            mixed = (gram + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(48)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and the folded matrix (bins by languages)."""

    languages: tuple[str, ...]
    weights: np.ndarray


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` different texts of each ``lang``, by hash; counts first, so few rows are ranked."""
    different = labelled.select("lang", F.xxhash64("text").alias("_hash")).distinct()
    counts = different.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    languages = counts.count()
    per_language = max(1, min(per_language, SAMPLE_ROWS // max(languages, 1)))
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    likely = labelled.join(F.broadcast(counts) if languages <= 10_000 else counts, "lang").where(
        chance * F.col("_n") < 2.0 * per_language
    ).select("lang", "text").distinct()
    ranked = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    return likely.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= per_language)


def train(
    labelled: DataFrame,
    per_language: int = SAMPLE_PER_LANGUAGE,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
) -> LanguageModel:
    """Learn from columns ``text`` and ``lang``; rows without either are left out.

    Presence vectors are made by the executors; at most ``per_language`` of them
    per language, and about ``SAMPLE_ROWS`` in all, of ``BINS`` bits each, come to the
    driver. A text repeated exactly takes one of these places. No rows give a model
    without languages.
    """
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", SLICE_BYTES):
            bits = []
            for text in batch.column("text").to_pylist():
                flags = np.zeros(BINS, dtype=np.uint8)
                for bins in presence(text):
                    flags[bins] = 1
                bits.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("_rank"), pa.array(bits, pa.binary())], ["lang", "rank", "bits"]
            )

    rows = _sample(usable, per_language).mapInArrow(vectors, "lang string, rank int, bits binary").collect()
    rows.sort(key=lambda r: (r["rank"], r["lang"], bytes(r["bits"])))
    languages = tuple(sorted({r["lang"] for r in rows}))
    if not languages:
        return LanguageModel((), np.zeros((BINS, 0), np.float32))
    packed = np.stack([np.frombuffer(r["bits"], dtype=np.uint8) for r in rows])
    targets = np.array([[r["lang"] == name for name in languages] for r in rows], dtype=float)
    chosen = np.unpackbits(packed[:landmarks], axis=1).astype(np.float32)
    chosen /= np.sqrt(np.maximum(chosen.sum(axis=1, keepdims=True), 1))
    kernel = []
    for i in range(0, len(packed), 128):
        part = np.unpackbits(packed[i : i + 128], axis=1).astype(np.float32)
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1))
        kernel.append(part @ chosen.T)
    kernel = np.concatenate(kernel).astype(float)
    own = kernel[: len(chosen)]
    values, axes = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-8 * max(values.max(), 1e-12)
    root = axes[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    inner = features.T @ features + ridge * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(inner, features.T @ targets)
    return LanguageModel(languages, np.ascontiguousarray(chosen.T @ weights.astype(np.float32), dtype=np.float32))


def classify(
    docs: DataFrame,
    model: LanguageModel,
    columns: list[Column],
    text_column: str = "text",
    added: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``columns`` of every row of ``docs``, and the language and its score as columns ``added``.

    A score is the language's share of the positive outputs, 0 to 1; of equal
    outputs the first language by name wins. Texts that are null or have no letter
    are ``und`` with score 0, as is everything if nothing was learned.
    """
    slim = docs.select(*columns, F.col(text_column).alias("__text"))
    names = slim.columns[:-1]
    folded = np.concatenate([model.weights, np.ones((BINS, 1), np.float32)], axis=1)
    languages = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        forget()
        letter = regex.compile(r"\p{L}").search
        matrix = np.zeros((ROWS_PER_PRODUCT, BINS), dtype=np.float32)
        for batch in slices(batches, "__text"):
            texts = batch.column("__text").to_pylist()
            found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if languages and t and letter(t)]
            for k in range(0, len(known), ROWS_PER_PRODUCT):
                rows = known[k : k + ROWS_PER_PRODUCT]
                matrix[: len(rows)] = 0
                for r, i in enumerate(rows):
                    for bins in presence(texts[i]):
                        matrix[r, bins] = 1
                product = matrix[: len(rows)] @ folded
                outputs = np.maximum(product[:, :-1] / np.sqrt(product[:, -1:]), 0).astype(float)
                best = outputs.argmax(axis=1)
                share = outputs[np.arange(len(rows)), best] / np.maximum(outputs.sum(axis=1), 1e-12)
                scores[rows] = np.clip(share, 0, 1)
                for i, b in zip(rows, best, strict=True):
                    found[i] = languages[b]
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.string()), pa.array(scores)], [*names, *added]
            )

    return slim.mapInArrow(run, extended(slim.drop("__text").schema, f"{added[0]} string, {added[1]} double"))


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text leaves 1 modulo 3. Null ids are not."""
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``; repeated rows repeat."""
    return classify(docs, model, [F.col("doc_id"), held_out().alias("held_out")])


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.0) -> DataFrame:
    """Rows of ``docs`` whose language was found with at least ``min_score``; columns unchanged.

    If no language could be learned, rows whose text has a letter.
    """
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = classify(docs, model, columns, added=("__lang", "__score"))
    return found.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= min_score)).select(*columns)
