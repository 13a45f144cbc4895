"""Mixture-controlled packing: deficit round-robin over one queue for each source.

In every round a queue is credited its quantum, its share of a sequence, and sends
what the credit covers in grains of a few tokens; what is left of the credit, the
deficit, is carried on. The tokens sent, round after round and source after source,
are one stream, and sequences are cut from it, so that a sequence which ends within a
round leaves the deficits to the next.

Credits are whole numbers of 2^-16 tokens, so that the round in which any token of a
queue is sent has a closed form. A partition therefore knows the deficits that it
starts with from the places of its documents in their queues, and no loop over
sequences runs anywhere. Places in queues and in the stream are running totals, taken
within partitions or blocks of rounds and across them by one row for each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import extended, kept, slices, text_or_empty
from martloom.llm.word_ids import WordTokenizer
from martloom.plans.shared import materialize

CAPACITY = 4096
END_ID = 2
GRAIN = 16
# Binary places of a credit; rounds in a block; blocks in a group of blocks.
PLACES = 16
BLOCK_ROUNDS = 256
GROUP_BLOCKS = 4096


def id_type(tokenizer_path: str, end_id: int = END_ID) -> str:
    """Numpy type in which ids of a tokenizer file travel: two bytes if all fit, else four."""
    from tokenizers import Tokenizer

    largest = max(end_id, *Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values())
    return "<u2" if largest < 1 << 16 else "<u4"


def queued_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, source, doc_tokens, ids, _row``, stored; ``_row`` is the order in which documents queue up.

    ``ids`` are little-endian, as wide as the vocabulary asks for (``id_type``).
    """
    stored_as = id_type(tokenizer_path, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept(f"words of {tokenizer_path}", lambda: WordTokenizer(tokenizer_path))
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text", 4 << 20):
            ids = [np.frombuffer(found + end, "<u4") for found in tokenizer.encode(batch.column("text").to_pylist())]
            counts = pa.array([len(found) for found in ids], pa.int64())
            stored = pa.array([found.astype(stored_as).tobytes() for found in ids], pa.binary())
            columns = [batch.column("doc_id"), batch.column("source"), counts, stored]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "doc_tokens", "ids"])

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        text_or_empty().alias("text"),
    )
    encoded = slim.mapInArrow(encode, "doc_id long, source string, doc_tokens long, ids binary")
    return materialize(encoded.withColumn("_row", F.monotonically_increasing_id()), "queued_documents")


def _queue_places(queued: DataFrame, targets: Mapping[str, float] | None, capacity: int) -> DataFrame:
    """``_row, source, doc_tokens, begin, quantum``: where each document starts in its source's queue."""
    part = F.shiftright("_row", 33).alias("_part")
    slim = queued.select("_row", "source", "doc_tokens", part)
    per_part = materialize(slim.groupBy("source", "_part").agg(F.sum("doc_tokens").alias("n")), "queue_parts")
    total = per_part.agg(F.sum("n")).first()[0] or 0
    named = dict(targets or {})
    if any(not 0 < share <= 1 for share in named.values()) or sum(named.values()) > 1 + 1e-9:
        raise ValueError("targets must be positive and add up to 1 at most")
    share = F.col("_all") / F.lit(float(max(total, 1)))
    if named:
        given = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])[F.col("source")]
        known = per_part.where(F.col("source").isin(list(named))).agg(F.sum("n")).first()[0] or 0
        left = max(0.0, 1 - sum(named.values())) / max(total - known, 1)
        share = F.coalesce(given, F.col("_all") * F.lit(left))
    whole = Window.partitionBy("source")
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.withColumn("_all", F.sum("n").over(whole)).select(
        "source",
        "_part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"),
        F.greatest(F.lit(1), F.round(share * F.lit(float(capacity << PLACES)))).cast("long").alias("quantum"),
    )
    so_far = Window.partitionBy("source", "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    placed = slim.join(bases, ["source", "_part"]).withColumn("_end", F.sum("doc_tokens").over(so_far) + F.col("_base"))
    return placed.select("_row", "source", "doc_tokens", (F.col("_end") - F.col("doc_tokens")).alias("begin"), "quantum")


def sent_pieces(
    begin: np.ndarray, tokens: np.ndarray, quanta: np.ndarray, grain: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, round, start in the document, length) of what each document sends in each round.

    Grain u of a queue, from 1, is sent in the first round k whose credit covers it:
    the smallest k with k * quantum >= u * grain, in parts of a token.
    """
    first = begin // grain
    units = -(-(begin + tokens) // grain) - first
    doc = np.repeat(np.arange(len(begin)), units)
    unit = np.arange(len(doc)) - np.repeat(np.cumsum(units) - units, units) + first[doc]
    sent = -((-(unit + 1) * (grain << PLACES)) // quanta[doc])
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (sent[1:] != sent[:-1])
    heads = np.flatnonzero(new)
    lasts = np.append(heads[1:], len(doc)) - 1
    doc, sent = doc[heads], sent[heads]
    start = np.maximum(unit[heads] * grain, begin[doc])
    end = np.minimum((unit[lasts] + 1) * grain, begin[doc] + tokens[doc])
    return doc, sent, start - begin[doc], end - start


def _pieces(places: DataFrame, grain: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            begin, tokens, quanta = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("begin", "doc_tokens", "quantum")
            )
            doc, sent, start, length = sent_pieces(begin, tokens, quanta, grain)
            index = pa.array(doc)
            columns = [batch.column("_row").take(index), batch.column("source").take(index)]
            columns += [pa.array(x) for x in (sent, begin[doc] + start, start, length)]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "source", "round", "place", "start", "length"])

    return places.mapInArrow(run, "_row long, source string, round long, place long, start long, length long")


def _stream_places(pieces: DataFrame) -> tuple[DataFrame, int]:
    """``pieces`` (stored) with ``at``, their place in the stream, and the length of the stream."""
    blocked = pieces.withColumn("_block", F.floor(F.col("round") / BLOCK_ROUNDS))
    blocks = materialize(
        blocked.groupBy("_block")
        .agg(F.sum("length").alias("n"))
        .withColumn("_group", F.floor(F.col("_block") / GROUP_BLOCKS)),
        "stream_blocks",
    )

    def before(*keys: str):
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)

    groups = blocks.groupBy("_group").agg(F.sum("n").alias("n"))
    total = groups.agg(F.sum("n")).first()[0] or 0
    # One row for each million rounds or so.
    group_bases = groups.select("_group", F.coalesce(F.sum("n").over(before("_group")), F.lit(0)).alias("_far"))
    bases = (
        blocks.withColumn("_near", F.coalesce(F.sum("n").over(before("_group", "_block")), F.lit(0)))
        .join(group_bases, "_group")
        .select("_block", (F.col("_near") + F.col("_far")).alias("_base"))
    )
    order = Window.partitionBy("_block").orderBy("round", "source", "place").rowsBetween(Window.unboundedPreceding, 0)
    ended = blocked.withColumn("_end", F.sum("length").over(order)).join(bases, "_block")
    return ended.select(*pieces.columns, (F.col("_end") + F.col("_base") - F.col("length")).alias("at")), total


def cut_stream(at: np.ndarray, length: np.ndarray, total: int, capacity: int) -> tuple[np.ndarray, ...]:
    """(piece, start in the piece, length, sequence, offset) when a stream of ``total`` tokens is cut.

    Sequences are full but for the end of the stream, which is cut at powers of two, so
    that none of it needs padding.
    """
    full, rest = divmod(total, capacity)
    powers = [1 << i for i in reversed(range(rest.bit_length())) if rest >> i & 1]
    bounds = full * capacity + np.concatenate([[0], np.cumsum(powers)]).astype(np.int64)

    def sequence(x: np.ndarray) -> np.ndarray:
        return np.where(x < bounds[0], x // capacity, full + np.searchsorted(bounds, x, side="right") - 1)

    def opens(s: np.ndarray) -> np.ndarray:
        return np.where(s < full, s * capacity, bounds[np.clip(s - full, 0, len(bounds) - 1)])

    first, last = sequence(at), sequence(at + length - 1)
    times = last - first + 1
    piece = np.repeat(np.arange(len(at)), times)
    number = first[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(times) - times, times)
    start = np.maximum(at[piece], opens(number))
    end = np.minimum((at + length)[piece], opens(number + 1))
    return piece, start - at[piece], end - start, number, start - opens(number)


def _cut(placed: DataFrame, total: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, length, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "length", "start"))
            piece, inside, size, number, offset = cut_stream(at, length, total, capacity)
            columns = [batch.column("_row").take(pa.array(piece))]
            columns += [pa.array(x) for x in (start[piece] + inside, size, number, offset)]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "start", "length", "sequence_id", "offset"])

    slim = placed.select("_row", "start", "length", "at")
    return slim.mapInArrow(run, "_row long, start long, length long, sequence_id long, offset long")


def pack_mixture(
    docs: DataFrame,
    tokenizer_path: str,
    targets: Mapping[str, float] | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    grain: int = GRAIN,
    keep_ids: bool = False,
) -> DataFrame:
    """Pack ``docs`` so that every sequence mixes the sources in their target proportions.

    Columns ``doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset``, one
    row for each piece, and with ``keep_ids`` its ids as little-endian unsigned 32-bit
    integers. A document is its tokens and ``end_id``; it is cut where a round or a sequence
    ends. A source's tokens in a sequence differ from its target by less than ``grain`` for
    each source, as long as no queue is empty. All sequences are full, but the end of the
    stream, less than ``capacity`` tokens, is cut at powers of two.

    Args:
        targets: shares of the whole by source, adding up to 1 at most; sources not named
            share the rest in proportion to their tokens. By default all do, so that every
            sequence has the mixture of the corpus and the queues end together.
        grain: least number of tokens that a queue sends, other than at a document's ends.

    Null texts are empty and have the end id alone; null sources are the source ''. Rows that
    repeat, and null ids, are documents like others. No documents give no rows. Other
    columns are not read. Pieces of one document meet in one task.
    """
    queued = queued_documents(docs, tokenizer_path, end_id)
    places = _queue_places(queued, targets, capacity)
    placed, total = _stream_places(materialize(_pieces(places, grain), "sent_pieces"))
    cuts = _cut(placed, total, capacity)
    each = F.array_sort(F.collect_list(F.struct("start", "length", "sequence_id", "offset")))
    laid = queued.join(cuts.groupBy("_row").agg(each.alias("cuts")), "_row").drop("_row")
    schema = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    stored_as = id_type(tokenizer_path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, crcs, stored = [], [], [], []
            for row, (ids, cuts) in enumerate(zip(batch.column("ids"), batch.column("cuts"), strict=True)):
                whole = memoryview(np.frombuffer(ids.as_buffer(), stored_as).astype("<u4").tobytes())
                merged: list[list[int]] = []
                for cut in cuts.as_py():
                    start, length, number, offset = cut["start"], cut["length"], cut["sequence_id"], cut["offset"]
                    if merged and merged[-1][2] == number and merged[-1][3] + merged[-1][1] == offset:
                        merged[-1][1] += length
                    else:
                        merged.append([start, length, number, offset])
                for start, length, number, offset in merged:
                    part = whole[4 * start : 4 * (start + length)]
                    rows.append(row)
                    found.append((start, length, number, offset))
                    crcs.append(zlib.crc32(part))
                    if keep_ids:
                        stored.append(bytes(part))
            if not rows:
                continue
            index = pa.array(rows, pa.int64())
            start, length, number, offset = (pa.array(list(x), pa.int64()) for x in zip(*found, strict=True))
            taken = [batch.column(c).take(index) for c in ("doc_id", "source", "doc_tokens")]
            columns = [*taken[:2], start, length, pa.array(crcs, pa.int64()), taken[2], number, offset]
            names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                columns.append(pa.array(stored, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    wanted = laid.select("doc_id", "source", "doc_tokens", "ids", "cuts")
    out = wanted.limit(0).select("doc_id", "source").schema
    fields = schema.removeprefix("doc_id long, source string, ") + (", ids binary" if keep_ids else "")
    return wanted.mapInArrow(run, extended(out, fields))
