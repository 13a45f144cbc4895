"""Exact, near, line and substring deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martloom.llm import exact_dedup as exact
from martloom.llm import simhash, substring_dedup
from martloom.llm.components import connected_components, star_edges
from martloom.llm.exact_dedup import dedup_files
from martloom.llm.line_dedup import line_dedup, patience, without_spans
from martloom.llm.suffix_array import permuted_common_prefixes, suffix_array
from tests.llm.conftest import prose


def test_exact_dedup(spark, messy, tmp_path):
    path = str(tmp_path / "docs.parquet")
    messy.write.parquet(path)
    lower = {chr(c): chr(c + 32) for c in range(65, 91)}
    groups = {}
    rows = [(r.doc_id, "".join(lower.get(c, c) for c in r.text or "")) for r in messy.collect()]
    for doc_id, text in rows:
        groups.setdefault(text, []).append(doc_id)
    expected = []
    for doc_id, text in rows:
        ids = [i for i in groups[text] if i is not None]
        keep = max(ids) if ids else None
        expected.append((doc_id, keep, len(groups[text]), doc_id == keep, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in dedup_files(spark, path).collect())


def in_state(spark, docs, folder, digest=exact.sha256):
    """Documents as files, and the state of a stream over them."""
    path = f"{folder}/docs.parquet"
    docs.write.parquet(path)
    read = spark.read.parquet(path)
    return read, exact.stream_state(spark, path + "/", read.schema, f"{folder}/checkpoint", digest=digest)


def test_texts_that_share_a_digest_are_told_apart(spark, messy, tmp_path):
    """With sixteen digests nearly every one stands for several texts."""
    few = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    docs, state = in_state(spark, messy, tmp_path / "few", few)
    assert state.count() <= 16
    found = exact.exact_dedup(docs, state, digest=few)
    docs, state = in_state(spark, messy, tmp_path / "all")
    assert sorted(map(str, found.collect())) == sorted(map(str, exact.exact_dedup(docs, state).collect()))


def test_answers_are_the_entries_unless_their_locators_lead_nowhere(spark, messy, tmp_path):
    docs, state = in_state(spark, messy.where("doc_id < 14"), tmp_path)
    names = state.schema["value"].dataType.names
    fields = [F.col("value")[n].alias(n) for n in names]
    more = state.withColumn("value", F.struct((F.col("value")[names[0]] + 100).alias(names[0]), *fields[1:]))
    sizes = {r.doc_id: r.group_size for r in exact.exact_dedup(docs, more).collect()}
    assert all(n > 100 for n in sizes.values())
    lost = more.withColumn("value", F.col("value").withField(names[2], F.lit("elsewhere")))
    anew = {r.doc_id: r.group_size for r in exact.exact_dedup(docs, lost).collect()}
    plain = {r.doc_id: r.group_size for r in exact.exact_dedup(docs, state).collect()}
    assert all(anew[i] == n for i, n in plain.items() if n > 1)


def test_exact_dedup_of_nothing(spark, nothing, tmp_path):
    path = str(tmp_path / "none.parquet")
    nothing.write.parquet(path)
    assert dedup_files(spark, path).count() == 0


def union_find(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(i, i + 1) for i in range(100, 140)]
    expected = union_find(141, pairs)
    nodes, roots = star_edges(*map(np.array, zip(*pairs, strict=True)))
    local = dict(zip(nodes.tolist(), roots.tolist(), strict=True))
    assert [local.get(i, i) for i in range(141)] == expected
    found = dict(map(tuple, connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert [found.get(i, i) for i in range(141)] == expected


def test_fuzzy_keys_lose_no_pair_within_four_bits():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000).astype(np.uint64)
    near = prints.copy()
    for i in range(len(near)):
        for bit in rng.choice(64, 4, replace=False):
            near[i] ^= np.uint64(1) << np.uint64(bit)
    decoder = simhash.GolayDecoder()
    keys = [set(zip(*(c.tolist() for c in simhash.fuzzy_keys(p, decoder)), strict=True)) for p in (prints, near)]
    assert {row for row, _ in keys[0] & keys[1]} == set(range(3000))


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, messy, nothing):
    base = prose(5, 400).split()
    rows = [(100 + k, " ".join(base[:k] + ["changed"] + base[k + 1 :])) for k in range(0, 400, 20)]
    docs = messy.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [plain_print(t) for _, t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = union_find(len(texts), pairs)
    lowest = {}
    for (doc_id, _), r in zip(texts, root, strict=True):
        if doc_id is not None:
            lowest[r] = min(lowest.get(r, doc_id), doc_id)
    expected = [(d, f"{p:016x}", lowest.get(r)) for (d, _), p, r in zip(texts, prints, root, strict=True)]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in simhash.near_dedup(docs).collect())
    assert simhash.near_dedup(nothing).count() == 0


def test_keys_that_many_fingerprints_have_are_cut_into_blocks(spark, monkeypatch):
    """Fingerprints around one centre share keys; whatever the blocks, the same components come out."""
    rng = np.random.default_rng(12)
    centre, prints = 0x0123456789ABCDEF, set()
    while len(prints) < 400:
        prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)))
    prints = sorted(prints)
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    expected = union_find(len(prints), pairs)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "id long, fp long").repartition(4)
    for block in (10_000, 7):
        monkeypatch.setattr(simhash, "BLOCK", block)
        found = dict(map(tuple, connected_components(simhash.linked(nodes)).collect()))
        assert [found.get(i, i) for i in range(len(prints))] == expected


def test_near_copies(spark, messy, nothing):
    base = prose(6, 600).split()
    copies = [" ".join(base[:k] + ["edited"] + base[k + 1 :]) for k in range(0, 600, 40)]
    rows = [(200 + i, t) for i, t in enumerate([" ".join(base), *copies, prose(7, 600)])]
    docs = messy.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = sorted(((r.doc_id is not None, r.doc_id or 0, i), r.text) for i, r in enumerate(docs.collect()))
    prints = [plain_print(t) for _, t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = union_find(len(texts), pairs)
    expected = [key[1] if key[0] else None for i, (key, _) in enumerate(texts) if root[i] == i]
    kept = [r.doc_id for r in simhash.drop_near_copies(docs).collect()]
    assert 200 in kept and len(kept) < len(texts) - 10
    assert sorted(map(str, kept)) == sorted(map(str, expected))
    assert simhash.drop_near_copies(messy).columns == messy.columns
    assert simhash.drop_near_copies(nothing).count() == 0


def test_patience():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(12))] for _ in range(2))
        at = (0, 0)
        for i, j, n in patience(a, b):
            assert i >= at[0] and j >= at[1] and a[i : i + n] == b[j : j + n]
            at = (i + n, j + n)
    assert patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1, 2)]
    assert patience([], [1]) == []


def test_line_dedup(messy, nothing):
    got = line_dedup(messy)
    assert got.columns == [*messy.columns, "__n_lines", "__n_removed"]
    before = {r.doc_id: r.text for r in messy.collect()}
    rows = {r.doc_id: r for r in got.where("doc_id <> 14").collect()}
    assert rows[4].text is None and rows[5].text == "" and rows[1].text == before[1]
    assert (rows[2].text, rows[2]["__n_removed"]) == ("", 1)
    assert (rows[8].text, rows[8]["__n_lines"], rows[8]["__n_removed"]) == ("End.", 61, 60)
    assert rows[7].text == before[7] and rows[9].text == before[9]
    assert rows[10].text == before[10].split("\n")[-1]
    assert got.count() == messy.count() and line_dedup(nothing).count() == 0


def test_line_dedup_against_all_pairs(spark):
    """Each line's earliest holder is aligned with every later one."""
    rng = random.Random(8)
    lines = [prose(i, 12) for i in range(40)] + ["short"]
    texts = {i: "\n".join(rng.choice(lines) for _ in range(rng.randrange(9))) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup(docs).collect()}
    filled = {i: [x for x in t.split("\n") if x] for i, t in texts.items()}
    for i, own in filled.items():
        firsts = {min(k for k in filled if line in filled[k]) for line in own} - {i}
        spans = []
        for k in firsts:
            numbers = {v: n for n, v in enumerate({*filled[k], *own})}
            for _, j, n in patience([numbers[v] for v in filled[k]], [numbers[v] for v in own]):
                if sum(map(len, own[j : j + n])) >= 50:
                    spans.append(np.array([[j, j + n]], dtype="<u4").tobytes())
        assert got[i] == without_spans(texts[i], spans)[0]


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, k = rng.integers(0, 60), rng.integers(1, 5)
        s = np.concatenate([rng.integers(1, k + 1, n), [0]])
        sa = suffix_array(s, k + 1)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: tuple(s[i:]))
        common = permuted_common_prefixes(s.astype(np.uint8), sa, 8)
        for a, b in zip(sa[:-1], sa[1:], strict=True):
            if max(a, b) + 8 <= len(s):
                assert (common[b] == 8) == (s[a : a + 8].tolist() == s[b : b + 8].tolist())


def plain_removal(rows, length=100):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            if window in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, c in zip(raw, covered, strict=True) if not c)
        runs = sum(1 for k in range(len(covered)) if covered[k] and (k == 0 or not covered[k - 1]))
        out.append((doc_id, len(raw), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_substring_dedup(spark, messy, monkeypatch, hot):
    """With a limit of one segment all contested minimizers take the way of the hot ones."""
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", hot)
    period = prose(4, 1)[:7]
    rows = [(50, period * 90), (51, "b" * 50 + period * 40), (52, ("x" * 120 + "y") * 9), (53, "\0" * 400), (54, "a" * 99)]
    docs = messy.where("doc_id IS NOT NULL AND doc_id <> 14").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = plain_removal([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, substring_dedup.removal_report(docs).collect())) == sorted(expected)


def test_substring_dedup_keeps_columns_and_repeated_ids(messy, nothing):
    done = substring_dedup.substring_dedup(messy, in_text=True)
    assert done.columns == [*messy.columns, "__size", "__kept", "__removed"]
    rows = done.collect()
    assert len(rows) == messy.count() and sum(r.text is None for r in rows) == 2
    assert substring_dedup.substring_dedup(nothing).count() == 0
