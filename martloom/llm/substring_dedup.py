"""Removal of byte strings that occur earlier, by suffix arrays of shards.

Every ``length``-byte window of a text has a minimizer, the smallest hash of the
grams in it, so equal windows have equal minimizers wherever they stand. Runs of
windows with one minimizer are segments, and a segment goes where its minimizer's
hash sends it. There

* equal segments are collapsed onto the earliest, and the later ones are repeats
  as a whole; a task collapses what it has before it sends anything;
* minimizers with one segment only need no further look;
* the others, at the edges of repeated passages, form the shards whose suffix
  arrays are built. Neighbours with at least ``length`` bytes in common are equal
  windows, of which all but the earliest are repeats.

Minimizers with very many different segments (the edge of a passage that a large
part of all documents share) would put too much in one shard. Their segments are
sent on window by window, and equal windows are collapsed like equal segments.

Rows between the steps are arrays packed by destination, not one row per segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import extended, numbered, slices, text_or_empty
from martloom.llm.suffix_array import permuted_common_prefixes, suffix_array
from martloom.plans.shared import materialize

LENGTH = 100
GRAM = 24
# Windows in a segment at most; segments of a minimizer above which they are sent on by window.
SEGMENT_WINDOWS = 256
HOT_SEGMENTS = 2000
# Added to the number of windows of a segment that may repeat itself.
MAY_REPEAT = 1 << 32
SHARD_BYTES = 1 << 20
# Segments a task collapses before it sends them; text in one group of documents.
HELD_SEGMENTS = 300_000
GROUP_BYTES = 8 << 20
BATCH_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class RollingHash:
    """Hashes of any range of a byte array, from running sums of powers modulo 2^64."""

    def __init__(self, octets: np.ndarray):
        n = len(octets)
        base = 0x5851F42D4C957F2D
        powers = np.full(n + 1, base, dtype=np.uint64)
        self.inverse = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
        powers[0] = self.inverse[0] = 1
        powers, self.inverse = np.cumprod(powers, dtype=np.uint64)[:n], np.cumprod(self.inverse, dtype=np.uint64)
        values = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)[octets]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers, dtype=np.uint64)])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima within blocks, forwards and backwards."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(square, axis=1).ravel()
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def segments(texts: list[bytes], rows: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Keys (minimizers), digests, rows, starts and window counts of the segments of some texts."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    octets = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(octets) or sizes.max() < length:
        return none
    ends = np.cumsum(sizes)
    hashes = RollingHash(octets)
    grams, width = hashes.every(gram), length - gram + 1
    smallest = sliding_minimum(grams, width)
    inside = np.zeros(len(smallest), dtype=bool)
    begins = np.zeros(len(smallest) + 1, dtype=bool)
    for start, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if end - start >= length:
            inside[start : end - length + 1] = True
            begins[start] = True
    begins = begins[:-1]
    begins[1:] |= smallest[1:] != smallest[:-1]
    at = np.flatnonzero(begins & inside)
    stops = np.flatnonzero(np.concatenate([inside[:-1] & (begins[1:] | ~inside[1:]), inside[-1:]])) + 1
    counts = stops - at
    if len(counts) and counts.max() > SEGMENT_WINDOWS:
        pieces = -(-counts // SEGMENT_WINDOWS)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at, counts = np.repeat(at, pieces), np.repeat(counts, pieces)
        at, counts = at + number * SEGMENT_WINDOWS, np.minimum(counts - number * SEGMENT_WINDOWS, SEGMENT_WINDOWS)
    digests = hashes.ranges(at, at + counts + length - 1)
    # A segment in which its minimizer occurs twice may repeat itself.
    edge = np.full(width - 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    largest = ~sliding_minimum(np.concatenate([edge, ~smallest, edge]), width)
    chosen = np.flatnonzero(grams == largest)
    again = np.zeros(len(octets) + 1, dtype=np.int64)
    again[chosen[1:][grams[chosen[1:]] == grams[chosen[:-1]]] + 1] = 1
    again = np.cumsum(again)
    repeating = again[np.minimum(at + counts + width - 1, len(octets))] > again[at + 1]
    document = np.searchsorted(ends, at, side="right")
    return smallest[at], digests, rows[document], at - (ends - sizes)[document], counts | repeating * MAY_REPEAT


# Packed arrays: 8-byte columns one after another.
def _pack(columns: tuple[np.ndarray, ...], part: slice | np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(c[part]).tobytes() for c in columns)


def _unpack(payloads: list[bytes], kinds: str) -> tuple[np.ndarray, ...]:
    """Columns of the given types (``u`` unsigned, ``i`` signed) of some packed arrays, joined."""
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for payload in payloads:
        table = np.frombuffer(payload, dtype="<u8").reshape(len(kinds), -1)
        for k, kind in enumerate(kinds):
            parts[k].append(table[k] if kind == "u" else table[k].view(np.int64))
    return tuple(
        np.concatenate(p) if p else np.zeros(0, np.uint64 if k == "u" else np.int64)
        for p, k in zip(parts, kinds, strict=True)
    )


def _dealt(kind: int, columns: tuple[np.ndarray, ...], route: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """``columns`` packed by route."""
    if not len(route):
        return
    order = np.argsort(route, kind="stable")
    columns, route = tuple(c[order] for c in columns), route[order]
    cuts = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1], [True]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield kind, int(route[a]), _pack(columns, slice(a, b))


def _routed(keys: np.ndarray, routes: int) -> np.ndarray:
    return (_mixed(keys.view(np.uint64) + _ODD) % np.uint64(routes)).astype(np.int32)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds, routes, payloads = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.int32()), pa.array(routes, pa.int32()), pa.array(payloads, pa.binary())],
        ["kind", "route", "payload"],
    )


PACKED = "kind int, route int, payload binary"
# Kinds of packed rows.
SEGMENT, REPEAT, CONTESTED, HOT, TEXT, WINDOW = range(6)


def _collapsed(columns: tuple[np.ndarray, ...]) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Earliest of equal (key, digest, count) segments, sorted by key; and (row, start, count) of the others."""
    key, digest, row, start, count = columns
    order = np.lexsort((start, row, count, digest, key))
    key, digest, row, start, count = (c[order] for c in columns)
    first = np.ones(len(key), dtype=bool)
    first[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1]) | (count[1:] != count[:-1])
    later = row[~first], start[~first], count[~first] & (MAY_REPEAT - 1)
    return tuple(c[first] for c in (key, digest, row, start, count)), later


def repeated_windows(shard: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and starts of windows that stand earlier in a shard of segments (row, start, bytes), by suffix array."""
    shard = sorted(shard)
    sizes = np.array([len(s) for *_, s in shard])
    octets = np.frombuffer(b"".join(s + b"\0" for *_, s in shard), dtype=np.uint8)
    symbols = octets.astype(np.int32) + 2
    ends = np.cumsum(sizes + 1) - 1
    symbols[ends] = 1
    order = suffix_array(np.concatenate([symbols, np.zeros(1, np.int32)]), 258)[1:]
    common = permuted_common_prefixes(octets, order, length)
    segment = np.repeat(np.arange(len(shard)), sizes + 1)
    whole = np.arange(len(octets)) + length <= ends[segment]
    equal = (common >= length) & whole
    equal[order[1:]] &= whole[order[:-1]]
    # Equal windows are neighbours; a separator within a window keeps it from being whole.
    group = np.cumsum(~equal[order])
    tied = equal[order]
    tied[:-1] |= equal[order][1:]
    position, group = order[tied], group[tied]
    row = np.array([r for r, *_ in shard], dtype=np.int64)[segment[position]]
    start = np.array([s for _, s, _ in shard], dtype=np.int64)[segment[position]]
    start = start + position - (ends - sizes)[segment[position]]
    rank = np.lexsort((start, row, group))
    group, row, start = group[rank], row[rank], start[rank]
    later = np.zeros(len(group), dtype=bool)
    later[1:] = group[1:] == group[:-1]
    # The same window may be in two segments of one document; it is then no repeat of itself.
    same = np.zeros(len(group), dtype=bool)
    same[1:] = later[1:] & (row[1:] == row[:-1]) & (start[1:] == start[:-1])
    head = np.maximum.accumulate(np.where(~later, np.arange(len(group)), 0))
    later &= ~((row == row[head]) & (start == start[head])) if len(group) else later
    later &= ~same
    return row[later], start[later]


def _runs(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows as runs (row, start, count)."""
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(fresh)
    return row[at], start[at], np.diff(np.concatenate([at, [len(row)]]))


def removed_spans(start: np.ndarray, count: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes (start, end) that the windows of some runs cover."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], start[order] + count[order] + length - 1
    reach = np.maximum.accumulate(end)
    fresh = np.concatenate([[True], start[1:] > reach[:-1]]) if len(start) else np.zeros(0, bool)
    at = np.flatnonzero(fresh)
    last = np.concatenate([at[1:] - 1, [len(start) - 1]]) if len(at) else at
    return list(zip(start[at].tolist(), reach[last].tolist(), strict=True))


def substring_dedup(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id", in_text: bool = False
) -> DataFrame:
    """``docs`` with ``__size`` (in bytes), ``__kept`` (bytes that stay) and ``__removed`` (maximal runs cut out).

    A byte goes if a ``length``-byte string that covers it starts earlier too: in
    a document with a smaller id, or further up in the same one. Rows that repeat an
    id are separate documents and null ids come first. Null texts are empty; texts
    shorter than ``length`` lose nothing. All columns are kept; an empty table stays
    empty. ``__removed`` is an array of (start, end) in bytes of the input. With
    ``in_text`` the column ``text`` holds what is left, without characters that were
    cut apart (null stays null).
    """
    spark = docs.sparkSession
    rows = numbered(docs, id_column)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routes = 4 * parts
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    groups = max(parts, -(-total // GROUP_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def send() -> pa.RecordBatch:
            joined = tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            first, later = _collapsed(joined)
            out = list(_dealt(SEGMENT, first, _routed(first[0], routes)))
            return _batch(out + list(_dealt(REPEAT, later, _routed(later[0], groups))))

        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            found = segments(texts, batch.column("__row").to_numpy(), length, gram)
            if len(found[0]):
                held.append(found)
            if sum(len(h[0]) for h in held) > HELD_SEGMENTS:
                yield send()
        if held:
            yield send()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Collapse segments again, now from all tasks; tell contested minimizers from lone ones."""
        waiting = []
        for batch in batches:
            passing = []
            for kind, route, payload in zip(*[batch.column(c).to_pylist() for c in ("kind", "route", "payload")], strict=True):
                if kind == SEGMENT:
                    waiting.append(payload)
                else:
                    passing.append((kind, route, payload))
            if passing:
                yield _batch(passing)
        first, later = _collapsed(_unpack(waiting, "uuiii"))
        waiting.clear()
        out = list(_dealt(REPEAT, later, _routed(later[0], groups)))
        key, _, row, start, count = first
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        many = np.repeat(np.diff(np.concatenate([begin, [len(key)]])), np.diff(np.concatenate([begin, [len(key)]])))
        for kind, chosen in ((CONTESTED, ((many > 1) | (count >= MAY_REPEAT)) & (many <= HOT_SEGMENTS)), (HOT, many > HOT_SEGMENTS)):
            windows = count & (MAY_REPEAT - 1)
            columns = tuple(c[chosen] for c in (key.view(np.int64), row, start, windows))
            out += _dealt(kind, columns, _routed(columns[1], groups))
        yield _batch(out)

    def fetch(texts: pa.Table, packed: pa.Table) -> pa.Table:
        """Bytes of contested segments, window digests of hot ones, of a group of documents."""
        where = {}
        for kind, payload in zip(packed["kind"].to_pylist(), packed["payload"].to_pylist(), strict=True):
            where.setdefault(kind, []).append(payload)
        out = []
        if where:
            octets = texts["text"].cast(pa.binary()).to_pylist()
            found = dict(zip(texts["__row"].to_pylist(), octets, strict=True))
            if CONTESTED in where:
                columns = _unpack(where[CONTESTED], "iiii")
                out += _with_text(columns, found)
            if HOT in where:
                out += _with_windows(_unpack(where[HOT], "iiii"), found)
        return pa.Table.from_batches([_batch(out)])

    def _with_text(columns, found) -> Iterator[tuple[int, int, bytes]]:
        key, row, start, count = columns
        route = _routed(key, routes)
        order = np.argsort(route, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], route[order][1:] != route[order][:-1], [True]]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = order[a:b]
            sizes = count[part] + length - 1
            text = b"".join(
                found[r][s : s + n]
                for r, s, n in zip(row[part].tolist(), start[part].tolist(), sizes.tolist(), strict=True)
            )
            head = np.array([len(part)], dtype="<u8").tobytes()
            yield TEXT, int(route[part[0]]), head + _pack((key, row, start, count), part) + text

    def _with_windows(columns, found) -> Iterator[tuple[int, int, bytes]]:
        _, row, start, count = columns
        keys, digests, owners, places = [], [], [], []
        for r in np.unique(row).tolist():
            octets = np.frombuffer(found[r], dtype=np.uint8)
            mine = row == r
            at = np.unique(np.concatenate([np.arange(s, s + n) for s, n in zip(start[mine], count[mine], strict=True)]))
            hashes = RollingHash(octets)
            keys.append(hashes.ranges(at, at + length))
            digests.append(hashes.ranges(at, at + length // 2) ^ (hashes.ranges(at + length // 2, at + length) * _ODD))
            owners.append(np.full(len(at), r))
            places.append(at)
        columns = tuple(np.concatenate(c) for c in (keys, digests, owners, places))
        columns = (*columns, np.ones(len(columns[0]), dtype=np.int64))
        first, later = _collapsed(columns)
        yield from _dealt(WINDOW, first, _routed(first[0], routes))
        yield from _dealt(REPEAT, later, _routed(later[0], groups))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffix arrays of whole minimizers, about ``SHARD_BYTES`` at a time, and windows collapsed."""
        windows, payloads, columns = [], [], []
        for batch in batches:
            passing = []
            for kind, route, payload in zip(*[batch.column(c).to_pylist() for c in ("kind", "route", "payload")], strict=True):
                if kind == WINDOW:
                    windows.append(payload)
                elif kind == REPEAT:
                    passing.append((kind, route, payload))
                else:
                    n = int(np.frombuffer(payload, dtype="<u8", count=1)[0])
                    found = np.frombuffer(payload, dtype="<i8", count=4 * n, offset=8).reshape(4, n)
                    sizes = found[3] + length - 1
                    places = 8 + 32 * n + np.cumsum(sizes) - sizes
                    columns.append(np.vstack([found[:3], sizes, places, np.full(n, len(payloads))]))
                    payloads.append(payload)
            if passing:
                yield _batch(passing)
        _, later = _collapsed(_unpack(windows, "uuiii"))
        yield _batch(list(_dealt(REPEAT, later, _routed(later[0], groups))))
        if not columns:
            return
        key, row, start, size, place, payload = np.concatenate(columns, axis=1)
        columns.clear()
        order = np.argsort(key, kind="stable")
        # A shard ends with the first minimizer that fills it.
        filled = np.cumsum(size[order])
        last = np.flatnonzero(np.concatenate([key[order][1:] != key[order][:-1], [True]])) + 1
        begin = 0
        while begin < len(order):
            full = np.searchsorted(filled, (filled[begin - 1] if begin else 0) + SHARD_BYTES)
            end = int(last[np.searchsorted(last, min(full + 1, len(order)))])
            shard = [
                (r, s, payloads[p][at : at + n])
                for r, s, n, at, p in zip(
                    *(c[order[begin:end]].tolist() for c in (row, start, size, place, payload)), strict=True
                )
            ]
            runs = _runs(*repeated_windows(shard, length))
            yield _batch(list(_dealt(REPEAT, runs, _routed(runs[0], groups))))
            begin = end

    texts = rows.select("__row", text_or_empty().alias("text"))
    met = texts.mapInArrow(cut, PACKED).repartition(parts, "route", "kind").mapInArrow(meet, PACKED)
    met = materialize(met, "segments")
    # Groups of documents by the same hash as the packed rows: found in Python once, then a plain column.

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            route = _routed(batch.column("__row").to_numpy(zero_copy_only=False), groups)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(route)], [*batch.schema.names, "__route"])

    dealt = texts.mapInArrow(grouped, "__row long, text string, __route int")
    contested = met.where(f"kind IN ({CONTESTED}, {HOT})")
    fetched = dealt.groupBy("__route").cogroup(contested.groupBy("route")).applyInArrow(fetch, PACKED)
    settled = fetched.repartition(parts, "route", "kind").mapInArrow(settle, PACKED)
    settled = materialize(settled, "settled")

    names = [c for c in docs.columns]
    extra = "__size long, __kept binary, __removed array<struct<start: long, end: long>>"
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def apply(batch: pa.Table, packed: pa.Table) -> pa.Table:
        row, start, count = _unpack(packed["payload"].to_pylist(), "iii")
        order = np.argsort(row, kind="stable")
        row, start, count = row[order], start[order], count[order]
        sizes, kept, removed = [], [], []
        for r, text in zip(batch["__row"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
            raw = text or b""
            low, high = np.searchsorted(row, r), np.searchsorted(row, r, side="right")
            spans = removed_spans(start[low:high], count[low:high], length)
            left, at = [], 0
            for a, b in spans:
                left.append(raw[at:a])
                at = b
            left.append(raw[at:])
            sizes.append(len(raw))
            kept.append(b"".join(left))
            removed.append([{"start": a, "end": b} for a, b in spans])
        columns = [batch[c] for c in names]
        if in_text:
            there = batch["text"].is_valid().to_pylist()
            texts = [k.decode(errors="ignore") if t else None for t, k in zip(there, kept, strict=True)]
            columns[names.index("text")] = pa.array(texts, pa.string())
        columns += [pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, spans_type)]
        return pa.table(dict(zip([*names, "__size", "__kept", "__removed"], columns, strict=True)))

    whole = rows.mapInArrow(grouped, extended(rows.schema, "__route int"))
    repeats = met.where(f"kind = {REPEAT}").union(settled)
    return whole.groupBy("__route").cogroup(repeats.groupBy("route")).applyInArrow(apply, extended(docs.schema, extra))


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; see ``substring_dedup``."""
    done = substring_dedup(docs.select("doc_id", "text"), length)
    return done.select(
        "doc_id",
        F.col("__size").alias("n_bytes"),
        (F.col("__size") - F.octet_length("__kept")).alias("n_removed"),
        F.size("__removed").cast("long").alias("n_spans"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )
