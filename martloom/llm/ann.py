"""Nearest neighbours through low-dimensional stable projections.

Inner products become distances by one extra coordinate that gives every vector
the same length. Vectors are projected by a Gaussian (2-stable) matrix, so the
squared projected distance over the squared distance is chi-square distributed.
A kd-tree over the projections cuts the vectors into cells, one or more tasks
each, and each cell into leaves. A query visits leaves in the order of their
projected distance and verifies their vectors in full. It stops when the chi-square
test holds: any vector as near as its k-th would, with the asked probability,
have been projected nearer than the leaves still to come. Cells are visited the
same way: a query's own first, then every other that the test does not exclude.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import extended
from martloom.plans.shared import materialize

DIMENSIONS = 8
CONFIDENCE = 0.97
SEED = 7
CELL_ROWS = 16_384
LEAF_ROWS = 256
QUERIES_PER_TASK = 1_024
# Projected points that the cells' splits are read from: so many in all, and for each cell, whichever is more.
SPLIT_SAMPLE = 20_000
SAMPLE_PER_CELL = 16


def chi_square_quantile(p: float, m: int = DIMENSIONS) -> float:
    """Value below which a chi-square variable with ``m`` (even) degrees of freedom falls with probability ``p``."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(m // 2))

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Projection:
    """Vectors with the coordinate that evens out their lengths, and their projections."""

    def __init__(self, size: int, longest: float, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.matrix = np.random.default_rng(seed).standard_normal((size + 1, dimensions))
        self.longest = longest

    def stored(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0)
        return np.column_stack([vectors, np.sqrt(rest)]) @ self.matrix

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix[:-1]


def split_tree(points: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """Splits (axis, value) of a balanced tree with ``leaves`` (a power of two) leaves, in heap order."""
    tree: list[tuple[int, float]] = [(0, 0.0)] * leaves
    todo = [(1, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if node >= leaves:
            continue
        part = points[rows]
        axis = int(np.ptp(part, axis=0).argmax()) if len(rows) else 0
        value = float(np.median(part[:, axis])) if len(rows) else 0.0
        tree[node] = (axis, value)
        right = part[:, axis] > value
        todo += [(2 * node, rows[~right]), (2 * node + 1, rows[right])]
    return tree


def cells_of(points: np.ndarray, tree: list[tuple[int, float]]) -> np.ndarray:
    leaves = len(tree)
    axes, values = np.array([t[0] for t in tree]), np.array([t[1] for t in tree])
    node = np.ones(len(points), dtype=np.int64)
    for _ in range(leaves.bit_length() - 1):
        node = 2 * node + (points[np.arange(len(points)), axes[node]] > values[node])
    return (node - leaves).astype(np.int32)


def leaf_order(points: np.ndarray, leaf_rows: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree that halves the widest side."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf_rows:
            leaves.append(rows)
            continue
        part = points[rows]
        axis = int(np.ptp(part, axis=0).argmax())
        order = np.argpartition(part[:, axis], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return leaves


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes, points by boxes."""
    total = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        column = points[:, k : k + 1]
        total += np.maximum(np.maximum(low[:, k] - column, column - high[:, k]), 0) ** 2
    return total


def search(
    vectors: np.ndarray,
    projected: np.ndarray,
    queries: np.ndarray,
    asked: np.ndarray,
    bounds: np.ndarray,
    k: int,
    longest: float,
    limit: float,
    ids: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and inner products of each query's ``k`` best vectors (-1 and -inf for none).

    Of equal products the vector of smaller ``ids`` is better. ``bounds`` holds squared
    distances of the k-th found elsewhere (infinite for none).
    Leaves are visited in waves that double; the stopping test runs between them.
    """
    best = np.full((len(queries), k), -np.inf)
    rows = np.full((len(queries), k), -1, dtype=np.int64)
    ids = np.append(ids, np.iinfo(np.int64).max)
    if not len(vectors):
        return rows, best
    leaves = leaf_order(projected, LEAF_ROWS)
    low = np.stack([projected[leaf].min(axis=0) for leaf in leaves])
    high = np.stack([projected[leaf].max(axis=0) for leaf in leaves])
    distance = box_distances(asked, low, high)
    order = np.argsort(distance, axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(leaves))[None, :], axis=1)
    nearest = np.take_along_axis(distance, order, axis=1)
    norms = (queries**2).sum(axis=1) + longest**2
    seen, wave = 0, 1
    active = np.arange(len(queries))
    while len(active) and seen < len(leaves):
        kth = np.minimum(bounds[active], np.maximum(norms[active] - 2 * best[active, -1], 0))
        active = active[~(nearest[active, seen] > limit * kth)]
        until = min(seen + wave, len(leaves))
        for number, leaf in enumerate(leaves):
            visits = active[(rank[active, number] >= seen) & (rank[active, number] < until)]
            if not len(visits):
                continue
            products = queries[visits] @ vectors[leaf].T
            better = products.max(axis=1) >= best[visits, -1]
            visits, products = visits[better], products[better]
            values = np.concatenate([best[visits], products], axis=1)
            where = np.concatenate([rows[visits], np.broadcast_to(leaf, products.shape)], axis=1)
            top = np.lexsort((ids[where], -values), axis=1)[:, :k]
            best[visits] = np.take_along_axis(values, top, axis=1)
            rows[visits] = np.take_along_axis(where, top, axis=1)
        seen, wave = until, wave * 2
    return rows, best


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the vectors that take part, each (id, vector) once.

    Left out: null or empty or zero vectors, vectors with null or non-finite
    components, and null ids.
    """
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.where(F.col(id_column).isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0))
        .select(F.col(id_column).cast("long").alias("vec_id"), vector.cast("array<double>").alias("v"))
        .distinct()
    )


def nearest(
    rows: DataFrame,
    is_query,
    k: int = 20,
    confidence: float = CONFIDENCE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` vectors with the largest inner product found for each query.

    Columns ``query_id, rank, vec_id, score``; ties go to the smaller id, a
    query's own id is never found. Equal vectors are searched once: each distinct
    vector carries its ``k + 1`` smallest ids, more of which no query can return.
    Vectors of different numbers of components have no inner product: each number is
    searched by itself, one after the other. No usable vectors give no rows.

    Args:
        is_query: condition on ``vec_id`` that makes a row a query.
        confidence: probability of the stopping test.
    """
    each = materialize(usable(rows, id_column, vector_column), "vectors")
    sizes = [r["n"] for r in each.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    found = [_nearest(each.where(F.size("v") == n), n, is_query, k, confidence) for n in sizes]
    nothing = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found) if found else nothing


def _sampled_points(distinct: DataFrame, projection: Projection, share: float) -> np.ndarray:
    """Projections of about a ``share`` of the vectors, chosen by hash; only these come to the driver."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = projection.stored(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([pa.array(points[:, i].copy()) for i in range(DIMENSIONS)], axes)

    axes = [f"p{i}" for i in range(DIMENSIONS)]
    chance = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = distinct.select("v").where(chance < share) if share < 1 else distinct.select("v")
    found = chosen.mapInArrow(project, ", ".join(f"{axis} double" for axis in axes)).toArrow()
    points = np.column_stack([found.column(axis).to_numpy() for axis in axes])
    return points[np.lexsort(points.T)]


def _nearest(each: DataFrame, size: int, is_query, k: int, confidence: float) -> DataFrame:
    """``nearest`` among ``each`` (``vec_id, v``), vectors of ``size`` components."""
    ranked = Window.partitionBy("v").orderBy("vec_id")
    distinct = (
        each.withColumn("_r", F.row_number().over(ranked))
        .where(F.col("_r") <= k + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("vid", F.monotonically_increasing_id())
    )
    distinct = materialize(distinct, "distinct_vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m")).first()
    longest, limit = math.sqrt(facts["m"]), chi_square_quantile(confidence)
    projection = Projection(size, longest)

    wanted = -(-facts["n"] // CELL_ROWS)
    cells = 1 << (wanted - 1).bit_length()
    sample = max(SPLIT_SAMPLE, SAMPLE_PER_CELL * cells)
    tree = split_tree(_sampled_points(distinct, projection, sample / facts["n"]), cells)

    axes = [f"p{i}" for i in range(DIMENSIONS)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = projection.stored(_matrix(batch.column("v")))
                more = [pa.array(cells_of(points, tree)), *[pa.array(points[:, i].copy()) for i in range(DIMENSIONS)]]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "cell", *axes])

    schema = extended(distinct.schema, ", ".join(["cell int", *[f"{axis} double" for axis in axes]]))
    index = materialize(distinct.mapInArrow(place, schema), "cells")
    sides = index.groupBy("cell").agg(*[F.min(a).alias(f"l{a}") for a in axes], *[F.max(a).alias(f"h{a}") for a in axes])
    boxes = sides.orderBy("cell").collect()
    numbers = np.array([b["cell"] for b in boxes], dtype=np.int32)
    low = np.array([[b[f"l{a}"] for a in axes] for b in boxes])
    high = np.array([[b[f"h{a}"] for a in axes] for b in boxes])

    asking = materialize(
        each.where(is_query).join(index.select("v", "vid", "cell"), "v").select("vec_id", "vid", "cell", "v"), "queries"
    )
    queries = asking.groupBy("vid").agg(F.first("v").alias("v"), F.first("cell").alias("cell"))
    queries = queries.withColumn("bound", F.lit(float("inf")))

    def in_cell(stored: pa.Table, asked: pa.Table) -> pa.Table:
        vectors, questions = _matrix(stored["v"]), _matrix(asked["v"])
        vids, qids, bounds = stored["vid"].to_numpy(), asked["vid"].to_numpy(), asked["bound"].to_numpy()
        lows = stored["low"].to_numpy()
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(vectors) and len(questions):
            points = projection.stored(vectors)
            for i in range(0, len(questions), 256):
                part = questions[i : i + 256]
                hits, _ = search(
                    vectors, points, part, projection.asked(part), bounds[i : i + 256], k + 1, longest, limit, lows
                )
                query, slot = np.nonzero(hits >= 0)
                hits = hits[query, slot]
                scores = np.einsum("ij,ij->i", part[query], vectors[hits])
                out.append((qids[i + query], vids[hits], scores))
        return pa.table(dict(zip(("qid", "vid", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    def searched(questions: DataFrame) -> DataFrame:
        """Each cell's vectors meet the cell's queries, so many at a time."""
        parts = questions.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("parts"))
        asked = questions.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int"))
        stored = index.select("cell", "vid", "v", F.col("ids")[0].alias("low")).join(parts, "cell")
        stored = stored.select("cell", "vid", "v", "low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        pairs = stored.groupBy("cell", "part").cogroup(asked.drop("parts").groupBy("cell", "part"))
        return pairs.applyInArrow(in_cell, "qid long, vid long, score double")

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                asked = projection.asked(_matrix(batch.column("v")))
                bound = batch.column("bound").to_numpy(zero_copy_only=False)
                near = ~(box_distances(asked, low, high) > limit * bound[:, None])
                near &= numbers[None, :] != batch.column("cell").to_numpy(zero_copy_only=False)[:, None]
                row, cell = np.nonzero(near)
                taken = batch.select(["vid", "v", "bound"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(numbers[cell])], [*taken.schema.names, "cell"])

    first = materialize(searched(queries), "own_cell")
    kth = first.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
    kth = kth.select(
        F.col("qid").alias("vid"), F.when(F.col("n") > k, F.greatest(longest**2 - 2 * F.col("s"), F.lit(-1e308))).alias("b")
    )
    bounded = queries.drop("bound").join(kth, "vid", "left")
    bounded = bounded.withColumn(
        "bound", F.coalesce(F.greatest(F.col("b") + norm, F.lit(0.0)), F.lit(float("inf")))
    ).select("vid", "v", "bound", "cell")
    more = searched(bounded.mapInArrow(elsewhere, "vid long, v array<double>, bound double, cell int"))

    top = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("ids")[0])
    found = (
        first.unionByName(more)
        .join(index.select("vid", "ids"), "vid")
        .withColumn("_r", F.row_number().over(top))
        .where(F.col("_r") <= k + 1)
        .select("qid", "ids", "score")
    )
    answers = asking.select(F.col("vec_id").alias("query_id"), F.col("vid").alias("qid")).join(found, "qid")
    answers = answers.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.distinct()
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
