"""Chat formatting of logged conversations, snapshots of growing ones collapsed.

Logs hold a conversation again after every turn. Each turn's prefix has a rolling
hash: the exclusive or of the hashes of (position, role, text) so far, twice with
different seeds, 128 bits in all. A conversation whose last prefix is an inner
prefix of another is an earlier snapshot of it and is left out by an anti join;
of equal conversations the smallest id stays. The maximal ones are rendered.

Long conversations are handled in parts of ``PART_TURNS`` turns: within a part
by a window, across parts by running totals of one row per part, so no
conversation is gathered whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.plans.shared import materialize

PART_TURNS = 1024


def _plain(column: str) -> Column:
    """Text that cannot be taken for a marker."""
    return F.replace(F.col(column), F.lit("<|"), F.lit("< |"))


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, role, text, p1, p2``: position from 1 and prefix hash of every turn.

    Turns are ordered by ``turn`` (null first), then role and text. Null roles and
    texts are empty, rows that repeat count once, rows without ``conv_id`` are left out.
    """
    rows = (
        turns.where("conv_id IS NOT NULL")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .distinct()
        .withColumn("_block", F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-(1 << 62))))
    )
    earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("conv_id", "_block").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "_block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("conv_id", "_block").orderBy("turn", "role", "text")
    placed = materialize(
        rows.join(before, ["conv_id", "_block"])
        .withColumn("pos", F.row_number().over(within) + F.col("_before"))
        .select(
            "conv_id",
            "_block",
            "pos",
            "role",
            "text",
            F.xxhash64("pos", "role", "text").alias("h1"),
            F.xxhash64(F.lit("second"), "text", "role", "pos").alias("h2"),
        ),
        "turns",
    )
    totals = placed.groupBy("conv_id", "_block").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    zero = F.lit(0).cast("long")
    starts = totals.select(
        "conv_id",
        "_block",
        F.coalesce(F.bit_xor("t1").over(earlier), zero).alias("s1"),
        F.coalesce(F.bit_xor("t2").over(earlier), zero).alias("s2"),
    )
    so_far = Window.partitionBy("conv_id", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(starts, ["conv_id", "_block"]).select(
        "conv_id",
        "pos",
        "role",
        "text",
        F.col("s1").bitwiseXOR(F.bit_xor("h1").over(so_far)).alias("p1"),
        F.col("s2").bitwiseXOR(F.bit_xor("h2").over(so_far)).alias("p2"),
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """``conv_id, n_turns, copies`` of conversations that no other one continues."""
    lengths = prefixes.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
    ends = prefixes.select("conv_id", "pos", "p1", "p2").join(lengths, "conv_id")
    distinct = (
        ends.where("pos = n_turns")
        .groupBy("n_turns", "p1", "p2")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    )
    inner = ends.where("pos < n_turns").select(F.col("pos").alias("n_turns"), "p1", "p2").distinct()
    return distinct.join(inner, ["n_turns", "p1", "p2"], "left_anti").select("conv_id", "n_turns", "copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations rendered with role markers.

    Columns ``conv_id, part, n_turns, copies, rendered``: one row per conversation,
    or per ``PART_TURNS`` turns of a longer one (``part`` from 0; ``rendered`` of the
    parts in order is the whole). ``copies`` counts equal conversations. An empty
    table has no rows; other columns are not read. See ``turn_prefixes`` for nulls
    and repeated rows.
    """
    prefixes = materialize(turn_prefixes(turns), "prefixes")
    chosen = maximal_conversations(prefixes)
    line = F.concat(F.lit("<|im_start|>"), _plain("role"), F.lit("\n"), _plain("text"), F.lit("<|im_end|>\n"))
    return (
        prefixes.select("conv_id", "pos", line.alias("line"))
        .join(chosen, "conv_id")
        .withColumn("part", F.floor((F.col("pos") - 1) / PART_TURNS).cast("int"))
        .groupBy("conv_id", "part", "n_turns", "copies")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
        .select("conv_id", "part", "n_turns", "copies", F.array_join("lines.line", "").alias("rendered"))
    )


ORACLE = f"""
    WITH rows AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                  FROM conversations WHERE conv_id IS NOT NULL),
    whole AS (SELECT conv_id, list(role || chr(0) || text ORDER BY turn NULLS FIRST, role, text) AS turns
              FROM rows GROUP BY conv_id),
    distinct_ones AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS copies FROM whole GROUP BY turns),
    inner_prefixes AS (SELECT DISTINCT list_slice(turns, 1, k) AS turns
                       FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM distinct_ones)),
    chosen AS (SELECT * FROM distinct_ones ANTI JOIN inner_prefixes USING (turns)),
    placed AS (SELECT conv_id, role, text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM rows)
    SELECT conv_id, CAST((pos - 1) // {PART_TURNS} AS INTEGER) AS part, CAST(any_value(len(turns)) AS BIGINT) AS n_turns,
           any_value(copies) AS copies,
           string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
                      || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
    FROM placed JOIN chosen USING (conv_id) GROUP BY ALL
"""
