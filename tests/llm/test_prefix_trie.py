import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from martloom.llm import prefix_trie as trie
from martloom.llm.prefix_trie import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, depth string, p1 int"


def plain_trie(rows):
    """The definition, spelled out with tuples."""
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        built[c] = tuple(first[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below, kids = defaultdict(list), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    out = []
    for node, convs in members.items():
        ending = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                kids[node],
                sum(1 for n in below[node] if not kids[n]),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below[node] if n),
                hashlib.sha256(ending.encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: (r[1], r[0]))


def found(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert frame.columns == names and all(t == "bigint" for _, t in frame.dtypes[:-1])
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[1], r[0]))


def conversations(seed):
    """Families of growing, equal and different conversations; nulls, ties, repeated rows, single turns."""
    rng = random.Random(seed)
    rows = []
    for family in (0, 100, 300, 700):
        for c in rng.sample(range(family, family + 100), 14) + ([family] if family != 700 else []):
            for t in range(rng.choice([1, 1, 2, 3, 5, 6, 7, 9])):
                text = rng.choice(["hi", "hi", "ho", "", None, "é日", "x" * 30]) if t < 6 else "same end"
                rows.append((c, t if rng.random() < 0.9 else None, ["user", "bot", None][t % 3], text))
    rows += [rows[0], rows[0], rows[7]]
    rows += [(None, 0, "user", "no conversation"), (-150, 0, "user", "hi"), (-50, 1, "user", "hi"), (-100, 0, "a", "b")]
    return [(*r, "x", 1) for r in rows]


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rows = conversations(seed)
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    assert found(prefix_trie(frame)) == plain_trie(rows)


def test_result_does_not_depend_on_the_sketch_or_blocks(spark, monkeypatch):
    rows = conversations(5)
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    monkeypatch.setattr(trie, "BLOCK", 2)
    monkeypatch.setattr(trie, "CHUNK", 64)
    for width in (16, 256, 4096):
        assert found(prefix_trie(frame, max_width=width)) == plain_trie(rows)


def test_estimates_prove_singletons(spark):
    """Prefixes screened out are those of one conversation, and with a wide sketch nearly all of these."""
    rows = conversations(8)
    _, whole = trie.rebuilt_turns(spark.createDataFrame(rows, TURNS))
    paths, n = trie.prefixes(whole)
    width = 1 << 16
    marked = trie.screened(paths, trie.shared_bits(paths, width), width).collect()
    held = defaultdict(set)
    for r in marked:
        held[r.p1, r.p2].add(r.conv_id)
    alone = [r for r in marked if r.alone]
    assert n == len(marked) and alone and all(len(held[r.p1, r.p2]) == 1 for r in alone)
    assert len(alone) >= 0.95 * sum(1 for convs in held.values() if len(convs) == 1)


def test_long_and_equal_conversations(spark):
    rows = [(c, t, "u", f"turn {t}", "", 0) for c in (1, 2, 400) for t in range(60)]
    rows += [(c, 0, "u", "equal", "", 0) for c in range(1000, 1150)]
    assert found(prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)


def test_empty_and_turnless(spark):
    assert prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    # Alone, a conversation of one turn whose head is taken from a family that is not there has no turn at all.
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6)
    rows = [(c, None, None, None, None, None)]
    assert found(prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)
    assert len(plain_trie(rows)) == 1
