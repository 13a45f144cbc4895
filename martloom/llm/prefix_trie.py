"""The trie of conversation prefixes, its shared nodes grouped exactly, its tails made where they are.

Every prefix of a rebuilt conversation has a digest: the exclusive or of 128-bit
hashes of (position, role, text). Tasks count digests into count-min sketches, which
are merged chunk by chunk; what is broadcast is one bit for each counter, "twice or
more". An estimate of one is never too low, so it proves that one conversation alone
has that prefix: its node is made from its own row, without a shuffle. The other
prefixes, those of the sketch's collisions among them, are grouped exactly, so the
sketch decides only what is shuffled.

Sums over subtrees need no rounds over levels. A node belongs to its smallest member;
the nodes of one conversation are a piece of its path. So a subtree's sum is the sum
of whole pieces over its members, less what its own piece has above it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.plans.shared import materialize, materialize_counted

BLOCK = 1024
HEAD_KINDS = 6
FAMILY = 100
# Counters of a sketch row: four for each prefix, within these bounds; 6 MB of bits are broadcast at most.
SKETCH_ROWS = 3
MIN_WIDTH, MAX_WIDTH = 1 << 16, 1 << 24
CHUNK = 1 << 16
SALTS = 8

_KEY = ["p1", "p2"]
_UP = ["q1", "q2"]


def _running(df: DataFrame, key: str, at: str, totals: dict[str, str], how: Callable[[str], Column]) -> DataFrame:
    """``df`` (stored) with running totals along ``at`` within ``key``, this row included.

    Within blocks of ``BLOCK`` positions by a window, across blocks by one row a block,
    so that no key is gathered whole.
    """
    blocked = df.withColumn("_block", F.floor(F.col(at) / BLOCK))
    per_block = blocked.groupBy(key, "_block").agg(*[how(c).alias(f"_{c}") for c in totals])
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = per_block.select(key, "_block", *[F.coalesce(how(f"_{c}").over(earlier), zero).alias(f"_{c}") for c in totals])
    so_far = Window.partitionBy(key, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    within = blocked.join(starts, [key, "_block"])
    added = {name: how(c).over(so_far) for c, name in totals.items()}
    joined = within.select(*df.columns, *[F.col(f"_{c}") for c in totals], *[v.alias(f"_r{n}") for n, v in added.items()])
    both = Column.bitwiseXOR if how is F.bit_xor else Column.__add__
    return joined.select(*df.columns, *[both(F.col(f"_{c}"), F.col(f"_r{n}")).alias(n) for c, n in totals.items()])


def _placed(turns: DataFrame) -> DataFrame:
    """``conv_id, _at, k1, k2, chars``: turns by hash, ``_at`` rising in the order of conversation and turn."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        # Equal rows are spread over tasks by it; which of them comes first makes no difference.
        F.monotonically_increasing_id().alias("_tie"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "_tie"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.monotonically_increasing_id().alias("_at"),
            F.xxhash64("role", "text").alias("k1"),
            F.xxhash64(F.lit("second"), "text", "role").alias("k2"),
            F.char_length("text").cast("long").alias("chars"),
        ),
        "placed_turns",
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of their family's first, and their turns.

    A conversation c has the first h turns of conversation c - c % 100 (all if fewer,
    none if there is no such), then its own turns after its first h; h is the unsigned
    crc32 of c in decimal, modulo 6. Turns are ordered by ``turn`` (null first), then role
    and text; null roles and texts are empty; repeated rows are turns each; rows without
    ``conv_id`` are left out.

    Returns:
        ``conv_id, length`` of every conversation, turnless ones too (stored);
        ``conv_id, depth, k1, k2, chars, last`` of every rebuilt turn, from depth 1.
    """
    placed = _placed(turns)
    stretch = F.shiftright("_at", 33).alias("_part")
    stretches = placed.groupBy("conv_id", stretch).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(stretches.groupBy("conv_id").agg(F.sum("n").alias("size")), "conversation_sizes")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_KINDS
    firsts = sizes.select(F.col("conv_id").alias("first_id"), F.col("size").alias("first_size"))
    taken = F.least("h", F.coalesce("first_size", F.lit(0)))
    convs = materialize(
        sizes.withColumn("h", head)
        .withColumn("first_id", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(firsts, "first_id", "left")
        .select(
            "conv_id",
            "first_id",
            "h",
            taken.alias("taken"),
            (taken + F.greatest(F.lit(0), F.col("size") - F.col("h"))).alias("length"),
        ),
        "conversations",
    )
    facts = stretches.select(
        "conv_id", "_part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    numbered = placed.withColumn("_part", stretch).join(facts, ["conv_id", "_part"])
    numbered = numbered.select("conv_id", (F.col("_at") + F.col("_shift")).alias("pos"), "k1", "k2", "chars")
    tails = numbered.join(convs, "conv_id").where("pos > h")
    tails = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "k1", "k2", "chars", "length")
    opening = numbered.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEAD_KINDS))
    heads = (
        opening.withColumnRenamed("conv_id", "first_id")
        .join(convs.where("taken > 0"), "first_id")
        .where("pos <= taken")
        .select("conv_id", F.col("pos").alias("depth"), "k1", "k2", "chars", "length")
    )
    whole = heads.union(tails)
    return convs.select("conv_id", "length"), whole.select(
        "conv_id", "depth", "k1", "k2", "chars", (F.col("depth") == F.col("length")).alias("last")
    )


def prefixes(turns: DataFrame) -> tuple[DataFrame, int]:
    """``conv_id, depth, chars, last, p1, p2, q1, q2`` of rebuilt ``turns``, stored, and their number.

    p is the digest of the prefix that ends with the turn, q of the one before it (0 for none).
    """
    hashed = turns.select(
        "conv_id",
        "depth",
        "chars",
        "last",
        F.xxhash64("depth", "k1", "k2").alias("x1"),
        F.xxhash64(F.lit("second"), "k2", "depth", "k1").alias("x2"),
    )
    summed = _running(materialize(hashed, "rebuilt_turns"), "conv_id", "depth", {"x1": "p1", "x2": "p2"}, F.bit_xor)
    before = [F.col(p).bitwiseXOR(F.col(x)).alias(q) for p, x, q in (("p1", "x1", "q1"), ("p2", "x2", "q2"))]
    return materialize_counted(summed.select("conv_id", "depth", "chars", "last", *_KEY, *before), "prefixes")


def _counters(batch: pa.RecordBatch, columns: list[str], width: int) -> list[np.ndarray]:
    """The counter of each row's digest, in each row of a sketch."""
    one, two = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in columns)
    shift = np.uint64(64 - (width.bit_length() - 1))
    return [((one + np.uint64(r) * (two | np.uint64(1))) >> shift).astype(np.int64) for r in range(SKETCH_ROWS)]


def shared_bits(digests: DataFrame, width: int) -> list[np.ndarray]:
    """For each sketch row, packed bits: whether a counter of ``width`` stands at two or more."""
    chunk = min(CHUNK, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((SKETCH_ROWS, width), dtype=np.uint8)
        for batch in batches:
            for row, at in zip(held, _counters(batch, _KEY, width), strict=True):
                where, times = np.unique(at, return_counts=True)
                row[where] = np.minimum(2, row[where] + np.minimum(times, 2))
        pieces = held.reshape(-1, chunk)
        for i in np.flatnonzero(pieces.any(axis=1)):
            packed = zlib.compress(pieces[i].tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([packed], pa.binary())], ["chunk", "held"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i.as_py(), h.as_py()) for b in batches for i, h in zip(b.column("chunk"), b.column("held"), strict=True))
        for i, parts in groupby(rows, key=lambda r: r[0]):
            total = np.zeros(chunk, dtype=np.uint8)
            for _, part in parts:
                total = np.minimum(2, total + np.frombuffer(zlib.decompress(part), dtype=np.uint8))
            bits = np.packbits(total > 1).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([bits], pa.binary())], ["chunk", "held"])

    schema = "chunk long, held binary"
    parts = digests.select(*_KEY).mapInArrow(count, schema)
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, schema)
    bits = np.zeros((SKETCH_ROWS * width // chunk, chunk // 8), dtype=np.uint8)
    for row in merged.collect():
        bits[row["chunk"]] = np.frombuffer(row["held"], dtype=np.uint8)
    return list(bits.reshape(SKETCH_ROWS, -1))


def screened(paths: DataFrame, bits: list[np.ndarray], width: int) -> DataFrame:
    """``paths`` with ``alone``: one conversation is proven to have the prefix; ``up_alone``: the one before it."""

    def proven(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
        found = np.zeros(batch.num_rows, dtype=bool)
        for row, at in zip(bits, _counters(batch, columns, width), strict=True):
            found |= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 0
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("depth").to_numpy(zero_copy_only=False) == 1
            alone, up = proven(batch, _KEY), proven(batch, _UP) & ~first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(alone), pa.array(up)], [*batch.schema.names, "alone", "up_alone"]
            )

    return paths.mapInArrow(run, "conv_id long, depth long, chars long, last boolean, p1 long, p2 long, q1 long, q2 long, "
                                 "alone boolean, up_alone boolean")  # fmt: skip


def _ends(rows: DataFrame) -> DataFrame:
    """``p1, p2, ends``: SHA-256 of each node's ``conv_id``, ascending, joined by commas; ids stream through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def finished() -> pa.RecordBatch:
            columns = [pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([state.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["p1", "p2", "ends"])

        for batch in batches:
            one, two, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("p1", "p2", "conv_id"))
            cuts = np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if a == b:
                    continue
                text = ",".join(map(str, ids[a:b].tolist())).encode()
                if now == (one[a], two[a]):
                    state.update(b"," + text)
                else:
                    if state is not None:
                        yield finished()
                    now, state = (one[a], two[a]), hashlib.sha256(text)
        if state is not None:
            yield finished()

    ordered = rows.select(*_KEY, "conv_id").repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id")
    return ordered.mapInArrow(run, "p1 long, p2 long, ends string")


def _with_parent(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """``children`` (with ``q1, q2``) with ``parent_conv_id``; a parent of very many is spread over tasks."""
    salted = children.withColumn("_salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    parents = nodes.select(
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    return salted.join(parents, [*_UP, "_salt"]).drop("_salt")


def prefix_trie(turns: DataFrame, max_width: int = MAX_WIDTH) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (see ``rebuilt_turns``), the empty one included.

    Columns, long: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``; and ``ends_sha256``. No
    conversations give no rows. Only ``conv_id, turn, role, text`` are read.

    Args:
        max_width: bound of a sketch row's counters. With more prefixes than it can tell
            apart, more of them are shuffled; the result is the same.
    """
    convs, whole = rebuilt_turns(turns)
    paths, rows = prefixes(whole)
    width = min(max(MIN_WIDTH, 1 << (4 * rows).bit_length()), max_width)
    rows_of = materialize(screened(paths, shared_bits(paths, width), width), "screened_prefixes")
    maybe = rows_of.where("NOT alone")
    zero = F.lit(0).cast("long")

    nodes = materialize(
        maybe.groupBy(*_KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("chars").alias("chars"),
            F.max("q1").alias("q1"),
            F.max("q2").alias("q2"),
            F.max("up_alone").alias("up_alone"),
        ),
        "trie_nodes",
    )
    tops = rows_of.where("alone AND NOT up_alone")
    children = nodes.where("NOT up_alone").select(*_UP).union(tops.select(*_UP))
    children = children.groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    children = materialize(children, "trie_children")

    # What each conversation adds to every node it is a member of: its own nodes' savings, and whether it is a leaf.
    leaves = nodes.join(children, _KEY, "left_anti").select("conv_id").union(rows_of.where("alone AND last").select("conv_id"))
    saving = ((F.col("n_convs") - 1) * F.col("chars")).alias("saving")
    chains = materialize(nodes.where("n_convs > 1").select("conv_id", "depth", *_KEY, saving), "trie_chains")
    weights = materialize(
        convs.join(leaves.withColumn("leaf", F.lit(1).cast("long")), "conv_id", "left")
        .join(chains.groupBy("conv_id").agg(F.sum("saving").alias("saving")), "conv_id", "left")
        .select("conv_id", "length", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("saving", zero).alias("saving")),
        "trie_weights",
    )
    adds = [F.sum("leaf").alias("n_leaves"), F.sum("saving").alias("below")]
    sums = maybe.select("conv_id", *_KEY).join(weights, "conv_id").groupBy(*_KEY).agg(*adds)
    above = _running(chains, "conv_id", "depth", {"saving": "so_far"}, F.sum)
    above = above.select(*_KEY, (F.col("so_far") - F.col("saving")).alias("above"))

    root = weights.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *adds).where("n_convs > 0")
    root = root.select(zero.alias("p1"), zero.alias("p2"), "conv_id", zero.alias("depth"),
                       F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
                       F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), F.col("below").alias("saved_tokens"))
    first = convs.agg(F.min("conv_id")).first()[0]
    own = nodes.where("up_alone OR depth = 1").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(first).cast("long")).otherwise(F.col("conv_id"))
    )
    below = _with_parent(nodes.where("NOT up_alone AND depth > 1"), nodes).select(*own.columns)
    exact = own.union(below).join(sums, _KEY).join(above, _KEY, "left").select(
        *_KEY, "conv_id", "depth", "parent_conv_id", "n_convs", "n_leaves",
        F.when(F.col("n_convs") > 1, F.col("below") - F.col("above")).otherwise(zero).alias("saved_tokens"),
    )
    ends = _ends(maybe.where("last").select(*_KEY, "conv_id").union(
        weights.where("length = 0").select(zero.alias("p1"), zero.alias("p2"), "conv_id")
    ))
    nobody = F.sha2(F.lit(b""), 256)
    shared = exact.union(root).join(children, _KEY, "left").join(ends, _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends", nobody).alias("ends_sha256"),
    )

    parent = F.when(F.col("depth") == 1, F.lit(first).cast("long")).otherwise(F.col("conv_id"))
    tail = rows_of.where("alone AND (up_alone OR depth = 1)").withColumn("parent_conv_id", parent)
    hanging = _with_parent(tops.where("depth > 1"), nodes).select(*tail.columns)
    one, no = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = tail.union(hanging).select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), F.when(F.col("last"), no).otherwise(one).alias("n_children"),
        one.alias("n_leaves"), no.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nobody).alias("ends_sha256"),
    )
    return shared.union(alone)


ORACLE = f"""
    WITH RECURSIVE bits(b, k, v) AS (
        SELECT b, 0, b FROM range(256) t(b)
        UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
    steps AS (SELECT b, v FROM bits WHERE k = 8),
    ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS digits FROM conversations WHERE conv_id IS NOT NULL),
    folded(conv_id, digits, i, v) AS (
        SELECT conv_id, digits, 0, CAST(4294967295 AS BIGINT) FROM ids
        UNION ALL SELECT f.conv_id, f.digits, f.i + 1, xor(f.v >> 8, s.v)
        FROM folded f JOIN steps s ON s.b = xor(f.v & 255, CAST(ascii(substr(f.digits, f.i + 1, 1)) AS BIGINT))
        WHERE f.i < length(f.digits)),
    heads AS (SELECT conv_id, xor(v, 4294967295) % {HEAD_KINDS} AS h FROM folded WHERE i = length(digits)),
    whole AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                                   ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
              FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    rebuilt AS (SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, list_slice(c.turns, 1, 0)), 1, h.h),
                                              list_slice(c.turns, h.h + 1, len(c.turns))) AS turns
                FROM whole c JOIN heads h ON h.conv_id = c.conv_id
                LEFT JOIN whole b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
    members AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
    nodes AS (SELECT list_slice(turns, 1, depth) AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                     sha256(coalesce(string_agg(CASE WHEN len(turns) = depth THEN CAST(conv_id AS VARCHAR) END, ','
                                                ORDER BY conv_id), '')) AS ends_sha256
              FROM members GROUP BY 1, 2),
    kids AS (SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
    valued AS (SELECT n.*, coalesce(k.n, 0) AS n_children,
                      CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.node[n.depth].t) END AS saved
               FROM nodes n LEFT JOIN kids k ON k.node = n.node),
    ups AS (SELECT node, unnest(range(0, depth + 1)) AS d, CAST(n_children = 0 AS INTEGER) AS leaf, saved FROM valued),
    sums AS (SELECT list_slice(node, 1, d) AS node, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved
             FROM ups GROUP BY 1)
    SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves,
           s.saved AS saved_tokens, v.ends_sha256
    FROM valued v JOIN sums s ON s.node = v.node
    LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.node = list_slice(v.node, 1, v.depth - 1)
"""
