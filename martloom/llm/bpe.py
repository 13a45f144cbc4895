"""Byte-level BPE over many pre-tokens at once.

Pre-tokens are put into matrices by length bucket, one row each, padded on the
right. In every round each row merges its leftmost pair of minimum rank: pair
ranks come from a hash table held in numpy arrays, the merged token replaces the
pair and the row closes up. Rows without a pair to merge leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import kept, slices, text_or_empty

NO_PAIR = np.int32(2**31 - 1)
# Rows longer than the last bucket merge with a heap instead, in n log n steps.
BUCKETS = (2, 4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256)
MAX_CACHED_WORDS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, space, rank in each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Rank of the token that two adjacent tokens spell, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NO_PAIR, dtype=np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot, self.probes = self._slot(keys), 1
        while len(keys):
            empty = np.flatnonzero(self.keys[slot] < 0)
            slots, first = np.unique(slot[empty], return_index=True)
            put = empty[first]
            self.keys[slots], self.values[slots] = keys[put], values[put]
            stay = np.ones(len(keys), dtype=bool)
            stay[put] = False
            keys, values, slot = keys[stay], values[stay], (slot[stay] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``NO_PAIR`` where they spell no token or one is padding (negative)."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys = np.where((left < 0) | (right < 0), np.int64(-2), keys)
        flat = keys.ravel()
        slot = self._slot(flat)
        seen = self.keys[slot]
        out = np.where(seen == flat, self.values[slot], NO_PAIR)
        open_ = np.flatnonzero((seen != flat) & (seen >= 0) & (flat >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[open_]]
            hit = seen == flat[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out.reshape(keys.shape)


class ByteBpe:
    """Encoder and decoder for a rank file that holds every single byte."""

    # White space beside a space.
    _CROWDED = re.compile(r" \s|\s ").search

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.table = PairTable(ranks)
        self.pairs = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.words: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes; every word has 1 to ``BUCKETS[-1]`` bytes."""
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        flat = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ids = np.full((len(words), width), -1, dtype=np.int32)
        ids[np.arange(width) < sizes[:, None]] = flat
        done = np.full_like(ids, -1)
        where = np.arange(len(words))
        ranks = self.table.rank(ids[:, :-1], ids[:, 1:])
        while len(where):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(at)), at]
            else:
                at, best = np.zeros(len(where), np.int64), np.full(len(where), NO_PAIR)
            over = best == NO_PAIR
            if over.any():
                done[where[over], : ids.shape[1]] = ids[over]
                keep = ~over
                where, ids, ranks, at, best = where[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not len(where):
                    break
            rows = np.arange(len(where))
            ids[rows, at] = best
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns >= at[:, None] + 1), axis=1)
            if ids.shape[1] > 1:
                ranks = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] > at[:, None]), axis=1)
                right = np.flatnonzero(at < ids.shape[1] - 1)
                ranks[right, at[right]] = self.table.rank(ids[right, at[right]], ids[right, at[right] + 1])
                left = np.flatnonzero(at > 0)
                ranks[left, at[left] - 1] = self.table.rank(ids[left, at[left] - 1], ids[left, at[left]])
            else:
                ranks = ranks[:, :0]
        full = done >= 0
        raw = done[full].astype("<u4").tobytes()
        ends = (np.cumsum(full.sum(axis=1)) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: the same merges, leftmost minimum rank first, from a heap."""
        ids = [int(i) for i in self.of_byte[np.frombuffer(word, dtype=np.uint8)]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        spell, pairs = self.tokens, self.pairs

        def rank(i: int) -> int | None:
            j = after[i]
            return pairs.get(spell[ids[i]] + spell[ids[j]]) if j < n else None

        heap = [(r, i) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            r, i = heapq.heappop(heap)
            if gone[i] or rank(i) != r:
                continue
            j = after[i]
            ids[i], gone[j], after[i] = r, 1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (again := rank(k)) is not None:
                    heapq.heappush(heap, (again, k))
        return np.array([t for t, g in zip(ids, gone, strict=True) if not g], dtype=np.int32)

    def _learn(self, words: list[str]) -> None:
        by_bucket: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode()
            at = bisect_left(BUCKETS, len(raw))
            by_bucket.setdefault(at, []).append((word, raw))
        for at, group in by_bucket.items():
            if at == len(BUCKETS):
                for word, raw in group:
                    self.words[word] = self.merge_long(raw).astype("<u4").tobytes()
                continue
            step = max(1, (1 << 20) // BUCKETS[at])
            for i in range(0, len(group), step):
                part = group[i : i + step]
                merged = self.merge_rows([raw for _, raw in part])
                self.words.update(zip([word for word, _ in part], merged, strict=True))

    def _know(self, cut: list[list[str]]) -> None:
        new = [w for w in set().union(*cut) if w not in self.words]
        if new:
            self._learn(new)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        A match of the pattern crosses no single space between two other
        characters, save to begin with it. Texts whose spaces all stand so are cut
        there, and the matches in a chunk are looked up by chunk.
        """
        if len(self.spaced) + len(self.words) > MAX_CACHED_WORDS:
            self.words, self.spaced = {}, {}
        plain = [None if self._CROWDED(t) else t.split(" ") for t in texts]
        heads = [self.find(t if p is None else p[0]) for t, p in zip(texts, plain, strict=True)]
        self._know(heads)
        tails = [p[1:] if p else [] for p in plain]
        chunks = [c for c in set().union(*tails) if c not in self.spaced]
        matches = [self.find(" " + c) for c in chunks]
        self._know(matches)
        get = self.words.__getitem__
        for chunk, found in zip(chunks, matches, strict=True):
            self.spaced[chunk] = b"".join(map(get, found))
        spaced = self.spaced.__getitem__
        return [
            b"".join(map(get, head)) + b"".join(map(spaced, tail))
            for head, tail in zip(heads, tails, strict=True)
        ]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    keep_ids: bool = False,
    text_column: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """Encode every whole text, decode the ids again, and report both.

    Columns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with
    ``keep_ids``, ``ids`` (little-endian unsigned 32-bit) and ``decoded``. A null
    text is empty, an empty text has no ids; repeated rows and null ids come out as
    they went in; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = kept(f"ranks of {ranks_path} {pattern}", lambda: ByteBpe(read_ranks(ranks_path), pattern))
        for batch in slices(batches, "text", 2 << 20):
            ids = bpe.encode(batch.column("text").to_pylist())
            decoded = [bpe.decode(i) for i in ids]
            columns = [
                batch.column("doc_id"),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return slim.mapInArrow(run, schema + (", ids binary, decoded binary" if keep_ids else ""))
