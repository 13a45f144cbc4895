"""Line deduplication by pairwise alignment.

Documents that overlap are found through the hashes of lines and of runs of lines
they share: every repeated one sends its later holders to its earliest one, so it
gives one pair per document, not one per two documents, however common it is. The
runs are those that just reach the least size of a block, from every line on and
up to every line, all of 2, 4, 8 ... lines, and the whole document. The two
documents of a pair are aligned by patience diff, anchored on lines that are
unique (else the rarest) in both, and aligned blocks are deleted from the later one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import extended, numbered, slices, text_or_empty
from martloom.plans.shared import materialize

# Blocks with fewer characters than this are left alone: headings, greetings, separators.
MIN_BLOCK_CHARS = 50
# An odd number and its inverse modulo 2**64, for hashes of runs.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        k = bisect_left(tails, value)
        if k:
            before[i] = at[k - 1]
        if k == len(tails):
            tails.append(value)
            at.append(i)
        else:
            tails[k], at[k] = value, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Aligned blocks (start in a, start in b, length), ordered, by patience diff.

    Common ends are matched; between them the lines unique in both ranges, in their
    longest common order, split the ranges, and each piece is treated the same way.
    Where no line is unique in both, the rarest common one splits them, its places
    taken in order.
    """
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alow, ahigh, blow, bhigh = todo.pop()
        while alow < ahigh and blow < bhigh and a[alow] == b[blow]:
            pairs.append((alow, blow))
            alow, blow = alow + 1, blow + 1
        while alow < ahigh and blow < bhigh and a[ahigh - 1] == b[bhigh - 1]:
            ahigh, bhigh = ahigh - 1, bhigh - 1
            pairs.append((ahigh, bhigh))
        if alow == ahigh or blow == bhigh:
            continue
        once_a: dict[int, int] = {}
        for i in range(alow, ahigh):
            once_a[a[i]] = -1 if a[i] in once_a else i
        once_b: dict[int, int] = {}
        for j in range(blow, bhigh):
            if once_a.get(b[j], -1) >= 0:
                once_b[b[j]] = -1 if b[j] in once_b else j
        common = sorted((once_a[v], j) for v, j in once_b.items() if j >= 0)
        chosen = [common[i] for i in increasing([j for _, j in common])]
        if not chosen:
            places_a: dict[int, list[int]] = {}
            places_b: dict[int, list[int]] = {}
            for i in range(alow, ahigh):
                places_a.setdefault(a[i], []).append(i)
            for j in range(blow, bhigh):
                if b[j] in places_a:
                    places_b.setdefault(b[j], []).append(j)
            if not places_b:
                continue
            rarest = min(places_b, key=lambda v: (len(places_a[v]) * len(places_b[v]), places_a[v][0]))
            chosen = list(zip(places_a[rarest], places_b[rarest], strict=False))
        pairs += chosen
        last = (alow, blow)
        for i, j in [*chosen, (ahigh, bhigh)]:
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
    blocks: list[tuple[int, int, int]] = []
    for i, j in sorted(pairs):
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1] = (*blocks[-1][:2], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def filled_lines(text: str) -> list[str]:
    """The lines of a text without surrounding white space; blank ones are empty."""
    return [line.strip() for line in text.split("\n")]


def _sequences(docs: DataFrame) -> DataFrame:
    """``__row, keys, chars``: 128-bit hashes (16 bytes each) and lengths of the lines that are not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, "text"):
            keys, chars = [], []
            for text in batch.column("text").to_pylist():
                lines = [line for line in filled_lines(text) if line]
                keys.append(b"".join(xxhash.xxh3_128_digest(line) for line in lines))
                chars.append(np.array([len(line) for line in lines], dtype="<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row"), pa.array(keys, pa.binary()), pa.array(chars, pa.binary())],
                ["__row", "keys", "chars"],
            )

    return docs.select("__row", text_or_empty().alias("text")).mapInArrow(run, "__row long, keys binary, chars binary")


def run_keys(lines: np.ndarray, chars: np.ndarray, min_chars: int) -> np.ndarray:
    """Hashes of runs of two or more lines with ``min_chars`` or more, from hashes and lengths of the lines.

    A block that two documents share is covered by runs of least size in it, so
    the earliest holder of each has that part of the block whole.
    """
    n = len(lines)
    ends = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    every = np.arange(n + 1)
    until = np.searchsorted(ends, ends + min_chars)
    since = np.searchsorted(ends, ends - min_chars, side="right") - 1
    starts = [every[until <= n], since[since >= 0], [0]]
    stops = [until[until <= n], every[since >= 0], [n]]
    length = 2
    while length < n:
        starts.append(every[: n - length + 1])
        stops.append(every[length:])
        length *= 2
    start, stop = np.concatenate(starts).astype(np.int64), np.concatenate(stops).astype(np.int64)
    keep = (stop - start > 1) & (ends[stop] - ends[start] >= min_chars)
    start, stop = start[keep], stop[keep]
    with np.errstate(over="ignore"):
        power = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, MULTIPLIER))])
        inverse = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, INVERSE))])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(lines.view(np.uint64) * power[:n], dtype=np.uint64)])
        mixed = (sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * MULTIPLIER
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _line_keys(sequences: DataFrame, min_chars: int) -> DataFrame:
    """``key, __row``: the first half of each line's hash, and the hashes of runs, once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for own, chars in zip(batch.column("keys").to_pylist(), batch.column("chars").to_pylist(), strict=True):
                lines = np.frombuffer(own, dtype="<i8")[::2].copy()
                keys.append(np.unique(np.concatenate([lines, run_keys(lines, np.frombuffer(chars, "<u4"), min_chars)])))
            if keys:
                rows = np.repeat(batch.column("__row").to_numpy(), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(rows)], ["key", "__row"])

    return sequences.select("__row", "keys", "chars").mapInArrow(run, "key long, __row long")


def _aligned(pairs: DataFrame, min_chars: int) -> DataFrame:
    """``__row, spans``: runs of lines (start, end; 4 bytes each) that the later document of a pair loses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spans = [], []
            columns = [batch.column(c).to_pylist() for c in ("__row", "first_keys", "keys", "chars")]
            for row, first, own, chars in zip(*columns, strict=True):
                number: dict[bytes, int] = {}
                a, b = (
                    [number.setdefault(keys[i : i + 16], len(number)) for i in range(0, len(keys), 16)]
                    for keys in (first, own)
                )
                sizes = np.frombuffer(chars, dtype="<u4")
                found = [(j, j + n) for _, j, n in patience(a, b) if sizes[j : j + n].sum() >= min_chars]
                if found:
                    rows.append(row)
                    spans.append(np.array(found, dtype="<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(spans, pa.binary())], ["__row", "spans"])

    return pairs.mapInArrow(run, "__row long, spans binary")


def without_spans(text: str, spans: list[bytes]) -> tuple[str, int, int]:
    """The text without the given runs of non-blank lines, the number of its lines, and of those removed."""
    lines = text.split("\n")
    filled = [i for i, line in enumerate(lines) if line.strip()]
    gone = np.zeros(len(filled) + 1, dtype=np.int64)
    for span in spans:
        for start, end in np.frombuffer(span, dtype="<u4").reshape(-1, 2).astype(np.int64):
            gone[start] += 1
            gone[end] -= 1
    drop = {filled[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) > 0)}
    return "\n".join(line for i, line in enumerate(lines) if i not in drop), len(filled), len(drop)


def line_dedup(docs: DataFrame, min_chars: int = MIN_BLOCK_CHARS, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` cleared of repeated blocks of lines, and ``__n_lines, __n_removed``.

    Deleted are the blocks of consecutive lines, of ``min_chars`` or more, that
    align with the earliest holder of one of the document's lines or runs of lines.
    An alignment keeps the order of both documents, so of lines that an earlier
    one has in another order, or of a passage that occurs more often, some may stay.

    Earlier is the smaller id; rows that repeat an id are separate documents, and
    null ids come first. Lines are compared without surrounding white space and
    counted where not blank. A null text stays null; a document may lose all its
    lines and stays as an empty one. All columns are kept; an empty table stays empty.
    """
    rows = numbered(docs, id_column)
    sequences = materialize(_sequences(rows), "line_sequences")
    lines = _line_keys(sequences, min_chars)
    holders = lines.groupBy("key").agg(F.min("__row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = lines.join(holders, "key").where("first <> __row").select("first", "__row").distinct()
    both = pairs.join(sequences, "__row").join(
        sequences.select(F.col("__row").alias("first"), F.col("keys").alias("first_keys")), "first"
    )
    spans = _aligned(both.select("__row", "first_keys", "keys", "chars"), min_chars)
    spans = spans.groupBy("__row").agg(F.collect_list("spans").alias("__spans"))

    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, counts, removed = [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                left, n, gone = without_spans(text or "", own or [])
                texts.append(left if text is not None else None)
                counts.append(n)
                removed.append(gone)
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "__n_lines", "__n_removed"])

    joined = rows.join(spans, "__row", "left").select(*[F.col(f"`{c}`") for c in names], "__spans")
    return joined.mapInArrow(cut, extended(docs.schema, "__n_lines long, __n_removed long"))
