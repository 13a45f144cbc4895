"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A 64-bit fingerprint is cut into three segments, each read as a word of the
perfect [23, 12] Golay code. Decoding a segment, and the segment with any one bit
turned, gives it up to six codeword indices; words that differ in at most two
bits share one. Of fingerprints within four bits, two segments differ in at most
two bits together (pigeonhole), so a pair of indices from those two segments is a
key that both have. Fingerprints that share a key are compared in full; a key that
very many different fingerprints have is cut into blocks, and a task gets two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import numbered, slices, text_or_empty
from martloom.llm.components import connected_components, star_edges
from martloom.plans.shared import materialize

WORDS = 4
MAX_DISTANCE = 4
SEED = 42
# Generator polynomial of the [23, 12] Golay code; lengths of the three segments.
GENERATOR = 0xAE3
SEGMENTS = (22, 21, 21)
# Fingerprints of one key that are compared as one block.
BLOCK = 8192


def simhash(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Fingerprint of a text's word shingles, repeats included; 0 for no words."""
    import xxhash

    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(found) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        octets = hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * ones > len(hashes)).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(
    docs: DataFrame,
    words: int = WORDS,
    seeds: tuple[int, ...] = (SEED,),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, fp`` for every row and seed; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            for seed in seeds:
                found = np.array([simhash(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


class GolayDecoder:
    """Nearest codeword's index (12 bits) of 23-bit words."""

    def __init__(self):
        def remainder(word: int) -> int:
            for bit in range(22, 10, -1):
                if word >> bit & 1:
                    word ^= GENERATOR << (bit - 11)
            return word

        of_bit = [remainder(1 << i) for i in range(23)]
        self.syndromes = np.zeros((3, 256), dtype=np.int32)
        for k in range(3):
            for value in range(256):
                for bit in range(8):
                    if value >> bit & 1 and 8 * k + bit < 23:
                        self.syndromes[k, value] ^= of_bit[8 * k + bit]
        self.errors = np.zeros(2048, dtype=np.int32)
        ones = [1 << i for i in range(23)]
        for i in range(23):
            self.errors[of_bit[i]] = ones[i]
            for j in range(i):
                self.errors[of_bit[i] ^ of_bit[j]] = ones[i] | ones[j]
                for k in range(j):
                    self.errors[of_bit[i] ^ of_bit[j] ^ of_bit[k]] = ones[i] | ones[j] | ones[k]

    def index(self, words: np.ndarray) -> np.ndarray:
        s = self.syndromes
        syndrome = s[0][words & 255] ^ s[1][words >> 8 & 255] ^ s[2][words >> 16]
        return (words ^ self.errors[syndrome]) >> 11


def fuzzy_keys(prints: np.ndarray, decoder: GolayDecoder) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of unsigned 64-bit fingerprints; every row has each of its keys once.

    Segments within two bits share an index of the one-bit surroundings, and
    segments within one bit share the index of either. So for each two segments it
    is enough to pair the own index of one with the surroundings of the other.
    """
    own, near = [], []
    shift = 0
    for bits in SEGMENTS:
        words = (prints >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)
        shift += bits
        turned = words[:, None] ^ np.concatenate([[0], 1 << np.arange(bits)])
        indices = decoder.index(turned)
        own.append(indices[:, 0].copy())
        indices.sort(axis=1)
        fresh = np.ones(indices.shape, dtype=bool)
        fresh[:, 1:] = indices[:, 1:] != indices[:, :-1]
        row, column = np.nonzero(fresh)
        near.append((row, indices[row, column]))
    rows, keys = [], []
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        row, index = near[j]
        rows.append(row)
        keys.append(kind << 24 | own[i][row] << 12 | index)
        row, index = near[i]
        other = index != own[i][row]
        rows.append(row[other])
        keys.append(kind << 24 | index[other] << 12 | own[j][row[other]])
    return np.concatenate(rows), np.concatenate(keys)


def _keys(nodes: DataFrame) -> DataFrame:
    """``key, id, fp``: every node under each of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = GolayDecoder()
        for batch in batches:
            rows, keys = fuzzy_keys(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), decoder)
            taken = [batch.column(c).take(pa.array(rows)) for c in ("id", "fp")]
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), *taken], ["key", "id", "fp"])

    return nodes.select("id", "fp").mapInArrow(run, "key int, id long, fp long")


def _in_blocks(keys: DataFrame) -> DataFrame:
    """``key, low, high, block, id, fp``: nodes of frequent keys once for every two blocks that they belong to."""
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    frequent = materialize(counts.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "frequent_keys")
    zero = F.lit(0)
    if frequent.isEmpty():
        return keys.select("key", zero.alias("low"), zero.alias("high"), zero.alias("block"), "id", "fp")
    rare = keys.join(frequent, "key", "left_anti")
    rare = rare.select("key", zero.alias("low"), zero.alias("high"), zero.alias("block"), "id", "fp")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    spread = keys.join(frequent, "key").withColumn("block", own)
    spread = spread.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    return rare.unionByName(spread.select("key", low, high, "block", "id", "fp"))


def linked(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges ``a, b`` with the same components as all pairs of ``nodes`` within ``max_distance`` bits.

    A task compares every two nodes that share a key, and gives one edge per node it
    linked, not one per pair.

    Args:
        nodes: long ``id``, unique; long ``fp``. Fingerprints should differ, so that
            copies do not meet here. They are read twice: pass a stored table.
    """
    if not 0 <= max_distance <= 4:
        raise ValueError("the keys are complete up to 4 bits")
    group = ["key", "low", "high"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lefts, rights, held = [], [], 0

        def compare(key, low, high, block, ids, prints) -> None:
            nonlocal lefts, rights, held
            at, step = np.arange(len(key)), 1
            while len(at):
                at = at[at + step < len(key)]
                to = at + step
                same = (key[at] == key[to]) & (low[at] == low[to]) & (high[at] == high[to])
                at, to = at[same], to[same]
                close = np.bitwise_count(prints[at] ^ prints[to]) <= max_distance
                # Two nodes of one block meet where it stands alone.
                close &= (low[at] == high[at]) | (block[at] != block[to])
                if close.any():
                    lefts.append(ids[at[close]])
                    rights.append(ids[to[close]])
                    held += len(lefts[-1])
                if held > 1 << 20:
                    left, right = star_edges(np.concatenate(lefts), np.concatenate(rights))
                    lefts, rights, held = [left], [right], 0
                step += 1

        rest = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(new[0]):
                continue
            new[5] = new[5].view(np.uint64)
            new = new if rest is None else [np.concatenate(pair) for pair in zip(rest, new, strict=True)]
            other = np.flatnonzero((new[0] != new[0][-1]) | (new[1] != new[1][-1]) | (new[2] != new[2][-1]))
            whole = int(other[-1]) + 1 if len(other) else 0
            compare(*(c[:whole] for c in new))
            rest = [c[whole:] for c in new]
        if rest is not None:
            compare(*rest)
        if lefts:
            left, right = star_edges(np.concatenate(lefts), np.concatenate(rights))
            yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a", "b"])

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _in_blocks(_keys(nodes)).repartition(parts, *group).sortWithinPartitions(*group)
    return dealt.mapInArrow(compared, "a long, b long")


def _rooted(printed: DataFrame, max_distance: int) -> tuple[DataFrame, DataFrame]:
    """``fp, root`` of the fingerprints of ``printed`` (``doc_id, fp``), and ``root, component_id``, its smallest id."""
    nodes = materialize(printed.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct_fingerprints")
    stars = connected_components(linked(nodes.select(F.col("fp").alias("id"), "fp"), max_distance))
    rooted = nodes.join(stars, nodes.fp == stars.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    return rooted.select("fp", "root"), rooted.groupBy("root").agg(F.min("low").alias("component_id"))


def near_dedup(
    docs: DataFrame,
    words: int = WORDS,
    max_distance: int = MAX_DISTANCE,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Documents link when their fingerprints differ in at most ``max_distance``
    bits; ``component_id`` is the smallest id reachable, null only where no
    document of the component has an id. Null and empty texts, and texts of white
    space, have fingerprint zero and link like any other. Repeated rows are copies
    of each other; an empty table has no rows; other columns are not read.
    """
    printed = materialize(fingerprints(docs, words, (seed,), id_column, text_column), "fingerprints")
    rooted, lowest = _rooted(printed, max_distance)
    found = rooted.join(lowest, "root").select("fp", "component_id")
    return printed.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, words: int = WORDS, max_distance: int = MAX_DISTANCE, seed: int = SEED, id_column: str = "doc_id"
) -> DataFrame:
    """``docs`` with one document, the one of smallest id, of each group of ``near_dedup``.

    Rows that repeat an id are separate documents, null ids come first; columns are
    unchanged and an empty table stays empty. Texts without words (null, empty, white
    space) have the same fingerprint: one of them stays.
    """
    rows = numbered(docs, id_column)
    printed = materialize(fingerprints(rows, words, (seed,), "__row"), "fingerprints")
    _, lowest = _rooted(printed, max_distance)
    kept = lowest.select(F.col("component_id").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
