"""Best-fit packing: length patterns fitted to the histogram by non-negative least squares.

Packing is decided on the histogram of lengths alone, which has at most
``capacity`` bins however many pieces there are:

1. patterns of one to three lengths that fill a sequence exactly are enumerated;
2. repeat counts are fitted to the histogram by non-negative least squares;
3. counts are rounded along the pattern order, within what the histogram holds;
4. what is left over goes best-fit decreasing, again on the histogram.

The result is a list of ranges "the pieces of length L with ranks r .. r+n-1 go
to sequences s .. s+n-1 at offset o". Ranks are given per hash bucket first, so
no length, however frequent, meets in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import extended, kept, slices, text_or_empty
from martloom.llm.word_ids import WordTokenizer
from martloom.plans.shared import materialize

CAPACITY = 4096
END_ID = 1
FIT_ROUNDS = 60


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    text_column: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """Tokens of every text, cut where a text is longer than a sequence.

    Columns ``doc_id, piece, start, length, ids_crc32`` and, with ``keep_ids``, the
    ids as little-endian unsigned 32-bit integers. A null text is empty and has the
    end id alone. Rows that repeat, and null ids, are documents like others.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept(f"words of {tokenizer_path}", lambda: WordTokenizer(tokenizer_path))
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text", 4 << 20):
            doc, piece, start, length, crc, stored = [], [], [], [], [], []
            texts = batch.column("text").to_pylist()
            for row, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts), strict=True):
                ids += end
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    doc.append(row)
                    piece.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        stored.append(part)
            columns = [
                pa.array(doc, pa.int64()),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(stored, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return slim.mapInArrow(encode, schema + (", ids binary" if keep_ids else ""))


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to three of ``lengths`` (largest first, 0 for none) that sum to ``capacity``."""
    there = np.zeros(capacity + 1, dtype=bool)
    there[lengths] = True
    rows = []
    if there[capacity]:
        rows.append(np.array([[capacity, 0, 0]]))
    for a in lengths[lengths < capacity][::-1]:
        rest = capacity - a
        if rest <= a and there[rest]:
            rows.append(np.array([[a, rest, 0]]))
        low = max(1, -(-rest // 2))
        b = np.arange(low, min(a, rest - 1) + 1)
        b = b[there[b] & there[rest - b]] if len(b) else b
        if len(b):
            rows.append(np.column_stack([np.full(len(b), a), b, rest - b]))
    return np.concatenate(rows).astype(np.int32) if rows else np.zeros((0, 3), np.int32)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring ``sum of x * pattern`` near the histogram (least squares).

    Accelerated projected gradient with one step size per pattern, from the
    number of patterns that share its lengths. Slot 0 stands for "no document".
    """
    size = len(histogram)

    def spread(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(patterns[:, k], weights=x, minlength=size) for k in range(3))
        total[0] = 0
        return total

    sharing = spread(np.ones(len(patterns)))
    step = 1.0 / np.maximum(sharing[patterns].sum(axis=1), 1.0)
    x = y = np.zeros(len(patterns))
    speed = 1.0
    for _ in range(rounds):
        short = histogram - spread(y)
        short[0] = 0
        better = np.maximum(0.0, y + step * short[patterns].sum(axis=1))
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        y = better + (speed - 1) / faster * (better - x)
        x, speed = better, faster
    return x


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Ranges (length, first rank, count, first sequence, offset) that place every piece once.

    Sorted by length and rank. The number of ranges depends on ``capacity``, not
    on the number of pieces.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} is not within 1..{capacity}")
        left[length] = count
    used = np.zeros_like(left)
    ranges: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, count: int, base: int, offset: int) -> None:
        ranges.append((length, int(used[length]), count, base, offset))
        used[length] += count
        left[length] -= count

    patterns = exact_patterns(np.flatnonzero(left), capacity)
    if len(patterns):
        fitted = np.cumsum(fit_counts(patterns, left.astype(float)))
        repeats = np.diff(np.floor(fitted + 1e-6), prepend=0).astype(np.int64)
        for p in np.flatnonzero(repeats):
            slots = [int(v) for v in patterns[p] if v]
            count = min(int(left[v]) // slots.count(v) for v in slots)
            count = min(count, int(repeats[p]))
            if count:
                offset = 0
                for v in slots:
                    place(v, count, sequences, offset)
                    offset += v
                sequences += count
    _best_fit_decreasing(left, capacity, sequences, place)
    return np.array(sorted(ranges), dtype=np.int64).reshape(-1, 5)


def _best_fit_decreasing(left: np.ndarray, capacity: int, sequences: int, place) -> None:
    """Place what is left, longest first, each into the fullest sequence that still holds it.

    Sequences with equal free space are kept as runs and are filled run by run.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []

    def free(space: int, base: int, count: int) -> None:
        if space and count:
            if space not in runs:
                runs[space] = []
                insort(spaces, space)
            runs[space].append((base, count))

    for length in range(capacity, 0, -1):
        while left[length]:
            want = int(left[length])
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                base, count = runs[space].pop()
                if not runs[space]:
                    del runs[space]
                    spaces.pop(at)
                taken = min(want, count)
                place(length, taken, base, capacity - space)
                free(space - length, base, taken)
                free(space, base + taken, count - taken)
            else:
                each = capacity // length
                full, rest = divmod(want, each)
                for copies, count in ((each, full), (rest, 1 if rest else 0)):
                    if count:
                        for k in range(copies):
                            place(length, count, sequences, k * length)
                        free(capacity - copies * length, sequences, count)
                        sequences += count


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; their ``length`` is 1 to ``capacity``.

    Args:
        pieces: a stored table (it is read twice), such as ``materialize`` returns.
        order: columns that tell pieces apart; equal pieces may change places.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = plan_packing(histogram, capacity)
    starts = (plan[:, 0] << 40) | plan[:, 1]

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        spread.groupBy("length", "_bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    )
    within = Window.partitionBy("_bucket", "length").orderBy(*order)
    ranked = (
        spread.repartition(buckets, "_bucket")
        .withColumn("_rank", F.row_number().over(within) - 1)
        .join(bases, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_base"))
        .select(*pieces.columns, "_rank")
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(starts, (length << 40) | rank, side="right") - 1
            found = [pa.array(plan[at, 3] + rank - plan[at, 1]), pa.array(plan[at, 4])]
            carried = [batch.column(name) for name in batch.schema.names if name != "_rank"]
            names = [name for name in batch.schema.names if name != "_rank"]
            yield pa.RecordBatch.from_arrays(carried + found, [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(assign, extended(pieces.schema, "sequence_id long, offset long"))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """Tokenize and pack ``docs`` into sequences of at most ``capacity`` tokens.

    No documents give no rows; null and empty texts are one token; repeated rows
    are packed once each; columns other than ``doc_id`` and ``text`` are not read.
    """
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, keep_ids=keep_ids), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], capacity)
