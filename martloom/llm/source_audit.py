"""How far the sources of each language differ in their words.

Every group (language and source) gives each kept term of its language a smoothed
share in billionths, zero counts included; two groups differ by the sum over terms
of (p - q)^2 / (p + q), each rounded down. All of it is whole numbers.

Pairs of groups are never emitted term by term. A term-major index lists who holds
each term; slices of it go to tasks, where every group scatters its terms through
the index into one accumulator over all its peers (row by row, after Gustavson). A
peer that lacks a term counts with its share for zero occurrences: the accumulator
starts from sums against those baselines, which need a group's different counts only,
and terms that both hold are corrected. Slices add up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import slices, text_or_empty
from martloom.plans.shared import materialize
from martloom.plans.sizing import broadcast_within

MIN_DOCS = 10
TOP_TERMS = 10
# Different terms counted at a time in a task, bytes of a text cut at a time, holders of terms in a slice.
HELD_TERMS = 300_000
PART_BYTES = 4 << 20
SLICE_HOLDERS = 1 << 19
# Languages whose statistics are broadcast; with more of them they are joined by shuffle.
MAX_BROADCAST_LANGUAGES = 10_000

# Letters stay, capitals become small, bytes beyond ASCII stay; everything else parts terms.
_PARTED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_COUNTS = "lang string, source string, term string, n long, docs long"
_SUMS = "part string, lang string, a string, b string, value long"


def _term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, part by part."""
    start = 0
    while start < len(text):
        end = min(len(text), start + PART_BYTES)
        part = text[start:end].translate(_PARTED)
        if end < len(text):
            # The last term may go on; it is left to the next part, unless it fills this one.
            cut = part.rfind(b" ") + 1
            while not cut and end < len(text):
                end = min(len(text), end + PART_BYTES)
                part = text[start:end].translate(_PARTED)
                cut = part.rfind(b" ") + 1 if end < len(text) else len(part)
            part = part[:cut]
        start += len(part)
        yield part.split()


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, summed up within tasks; terms may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple[Counter, Counter]] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in seen.items():
                terms = list(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(terms), pa.string()),
                        pa.array([source] * len(terms), pa.string()),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(n.values(), pa.int64()),
                        pa.array([in_docs[t] for t in terms], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
            seen.clear()

        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source")), texts, strict=True):
                n, in_docs = seen.setdefault((lang, source), (Counter(), Counter()))
                different: set[bytes] = set()
                for terms in _term_lists(text.as_py()):
                    n.update(terms)
                    different.update(terms)
                in_docs.update(different)
            if sum(len(n) for n, _ in seen.values()) > HELD_TERMS:
                yield from emptied()
        yield from emptied()

    slim = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
        text_or_empty().alias("text"),
    )
    return slim.mapInArrow(run, _COUNTS)


def shares(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 2) / (total + 2 kept))``, divided in steps so that nothing overflows."""
    below = np.asarray(total, dtype=np.int64) + 2 * kept
    share, rest = np.divmod(np.asarray(counts, dtype=np.int64) + 2, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        share = share * 1000 + more
    return share + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))`` of shares."""
    apart = p - q
    return apart * apart // (p + q)


class _Slice:
    """A slice of one language's index: the peers, and for each of its terms who holds it how often."""

    def __init__(self, rows: pa.Table, number: int):
        peers = rows.filter(pc.is_null(rows["term"]))
        held = rows.filter(pc.is_valid(rows["term"]))
        self.number = number
        self.sources = peers["source"].combine_chunks()
        self.totals = peers["total"].to_numpy()
        self.sizes = peers["terms"].to_numpy()
        self.kept = int(peers["kept"][0].as_py())
        self.terms = held["term"].combine_chunks()
        holders = held["holders"].combine_chunks()
        bounds = holders.offsets.to_numpy().astype(np.int64)
        flat = holders.flatten()
        peer = pc.index_in(flat.field("source"), value_set=self.sources).to_numpy(zero_copy_only=False).astype(np.int64)
        count = flat.field("n").to_numpy(zero_copy_only=False)
        term = np.repeat(np.arange(len(held)), np.diff(bounds))
        order = np.lexsort((peer, term))
        self.peer, self.count, self.term = peer[order], count[order], term
        self.ends = np.repeat(bounds[1:] - bounds[0], np.diff(bounds))
        if self.kept:
            self.p = shares(self.count, self.totals[self.peer], self.kept)
            self.p0 = shares(np.zeros(len(peers), np.int64), self.totals, self.kept)

    def rows_of_peers(self) -> Iterator[tuple[int, np.ndarray]]:
        """(group, what its accumulator holds): pairs get their shared part from the smaller of the two."""
        size = len(self.sources)
        by_peer = np.argsort(self.peer, kind="stable")
        starts = np.searchsorted(self.peer[by_peer], np.arange(size + 1))
        for g in range(size):
            row = np.zeros(size, dtype=np.int64)
            if self.kept:
                own = by_peer[starts[g] : starts[g + 1]]
                self._against_baselines(row, self.p[own])
                self._scatter(row, g, own)
                if self.number == 0:
                    rest = self.kept - self.sizes[g] - self.sizes[g + 1 :]
                    row[g + 1 :] += rest * gaps(self.p0[g], self.p0[g + 1 :])
            yield g, row

    def _against_baselines(self, row: np.ndarray, own: np.ndarray) -> None:
        values, repeats = np.unique(own, return_counts=True)
        step = max(1, (1 << 20) // len(row))
        for i in range(0, len(values), step):
            row += repeats[i : i + step] @ gaps(values[i : i + step, None], self.p0[None, :])

    def _scatter(self, row: np.ndarray, g: int, own: np.ndarray) -> None:
        """Correct, term by term, the peers after ``g`` that hold the term too."""
        reach = self.ends[own] - own - 1
        if not reach.sum():
            return
        first = np.cumsum(reach) - reach
        at = np.repeat(own + 1 - first, reach) + np.arange(reach.sum())
        p, q, peer = np.repeat(self.p[own], reach), self.p[at], self.peer[at]
        q0, p0 = self.p0[peer], self.p0[g]
        np.add.at(row, peer, gaps(p, q) - gaps(p, q0) - gaps(p0, q) + gaps(p0, q0))

    def top_terms(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, term, value) of each group's ``most`` terms in this slice that it prefers most."""
        if not self.kept or not len(self.terms):
            return (np.zeros(0, np.int64),) * 3
        together = np.zeros(len(self.terms), dtype=np.int64)
        np.add.at(together, self.term, self.count)
        q = shares(together, self.totals.sum(), self.kept)[self.term]
        place = np.empty(len(self.terms), dtype=np.int64)
        place[pc.sort_indices(self.terms.cast(pa.binary())).to_numpy()] = np.arange(len(self.terms))
        chosen = np.flatnonzero(self.p > q)
        value = gaps(self.p[chosen], q[chosen])
        order = np.lexsort((place[self.term[chosen]], -value, self.peer[chosen]))
        chosen, value = chosen[order], value[order]
        group = self.peer[chosen]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        return group[rank < most], self.term[chosen][rank < most], value[rank < most]


def _audited(most: int):
    def part(kind: str, lang: str, a: pa.Array, b: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([text] * len(value), pa.string()) for text in (kind, lang)]
        return pa.RecordBatch.from_arrays([*columns, a, b, pa.array(value)], ["part", "lang", "a", "b", "value"])

    def audit(lang: str, number: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_ = _Slice(pa.Table.from_batches(batches), number)
        names = slice_.sources
        for g, row in slice_.rows_of_peers():
            others = np.delete(np.arange(len(names)), g)
            low, high = np.minimum(others, g), np.maximum(others, g)
            yield part("pair", lang, names.take(pa.array(low)), names.take(pa.array(high)), row[others])
        group, term, value = slice_.top_terms(most)
        yield part("term", lang, names.take(pa.array(group)), slice_.terms.take(pa.array(term)), value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            start = 0
            keys = zip(batch.column("lang").to_pylist(), batch.column("slice").to_pylist(), strict=True)
            for now, run_of_rows in groupby(keys):
                if now != key and held:
                    yield from audit(*key, held)
                    held = []
                key, size = now, sum(1 for _ in run_of_rows)
                held.append(batch.slice(start, size))
                start += size
        if held:
            yield from audit(*key, held)

    return run


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Differences between the sources of each language, and the words that set a source apart.

    Columns ``lang, source, part, item, value, rank``. Part ``pair``: every other source
    of the language, by difference. Part ``term``: at most ``top_terms`` kept terms that
    the group uses more than its language does. Ties go to the smaller item in UTF-8 order.

    Terms are runs of ASCII letters, small, and of characters beyond ASCII; a language
    keeps those in at least ``min_docs`` of its documents. Null text, language and source
    count as empty. Groups without terms take part in the pairs; a language that keeps no
    term has differences of 0. Repeated rows are documents each. No documents, no rows.
    Only the columns ``text, lang, source`` are read.

    A language's sources must fit a task: it holds a few numbers for each of them.
    """
    by_term = count_terms(docs).repartition("lang", "term").groupBy("lang", "term", "source")
    held = by_term.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    index = materialize(
        held.groupBy("lang", "term")
        .agg(F.collect_list(F.struct("source", "n")).alias("holders"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .drop("docs"),
        "term_index",
    )
    each = index.select("lang", F.explode("holders").alias("h")).select("lang", "h.source", "h.n")
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    languages = materialize(
        index.groupBy("lang").agg(
            F.count(F.lit(1)).alias("kept"),
            F.ceil(F.sum(F.size("holders")) / F.lit(SLICE_HOLDERS)).cast("int").alias("slices"),
        ),
        "audited_languages",
    )
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    zero = F.lit(0).cast("long")
    peers = (
        docs.select(*named)
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select(
            "lang",
            F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)).alias("slice"),
            F.lit(None).cast("string").alias("term"),
            "source",
            *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "kept")],
            F.lit(None).cast(index.schema["holders"].dataType).alias("holders"),
        )
    )
    nothing = F.lit(None).cast("long")
    terms = index.join(broadcast_within(languages, MAX_BROADCAST_LANGUAGES), "lang").select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice"),
        "term",
        F.lit(None).cast("string").alias("source"),
        *[nothing.alias(c) for c in ("total", "terms", "kept")],
        "holders",
    )
    dealt = peers.union(terms).repartition("lang", "slice")
    dealt = dealt.sortWithinPartitions("lang", "slice", F.col("term").asc_nulls_first(), "source")
    sums = materialize(dealt.mapInArrow(_audited(top_terms), _SUMS), "audited")

    pair = sums.where("part = 'pair'").groupBy("part", "lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))]
    pairs = pair.select("lang", F.explode(F.array(*ways)).alias("way"), "part", "value")
    pairs = pairs.select("lang", "way.source", "part", "way.item", "value")
    words = sums.where("part = 'term'").select("lang", F.col("a").alias("source"), "part", F.col("b").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).union(words.select("*", rank).where(F.col("rank") <= top_terms))


ORACLE = rf"""
    WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    t AS (SELECT d, lang, source, unnest(terms) AS term FROM d),
    kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT d) >= {MIN_DOCS}),
    v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM d),
    counted AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
    filled AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
               FROM groups g JOIN kept k ON k.lang = g.lang
               LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    sizes AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM filled GROUP BY lang, source),
    p AS (SELECT f.lang, f.source, f.term, f.n, 1 + (1000000000 * (f.n + 2)) // (s.total + 2 * v.v) AS p
          FROM filled f JOIN sizes s ON s.lang = f.lang AND s.source = f.source JOIN v ON v.lang = f.lang),
    together AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM filled GROUP BY lang, term),
    whole AS (SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM together GROUP BY lang),
    q AS (SELECT t.lang, t.term, 1 + (1000000000 * (t.n + 2)) // (w.total + 2 * v.v) AS q
          FROM together t JOIN whole w ON w.lang = t.lang JOIN v ON v.lang = t.lang),
    pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
              GROUP BY a.lang, a.source, b.source),
    every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
              UNION ALL
              SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // (p.p + q.q)
              FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER)
                         AS rank FROM every)
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
