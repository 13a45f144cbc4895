import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from martloom.llm import source_audit
from martloom.llm.source_audit import audit_sources, gaps, shares
from tests.llm.conftest import DOCS, prose


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def audited(docs, min_docs, top=10):
    """The definition, spelled out over every group, peer and kept term."""
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text or ""))
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(terms)
        in_docs[lang or ""].update(set(terms))
    rows = []
    for lang, sources in groups.items():
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        size = len(kept)

        def share(of):
            total = sum(of[t] for t in kept) + 2 * size
            return {t: 1 + 1_000_000_000 * (of[t] + 2) // total for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(x, sum(gap(p[s][t], p[x][t]) for t in kept)) for x in sources - {s}]
            words = [(t, gap(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                rows += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(items[:most])]
    return sorted(rows)


def as_rows(frame):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in frame.collect())


@pytest.fixture(scope="module")
def sourced(spark, messy):
    texts = [r.text for r in messy.collect()]
    rows = [(t, lang, source) for i, t in enumerate(texts) for lang, source in [("en", f"s{i % 4}"), (None, None)][: 1 + i % 2]]
    rows += [(prose(200 + i, 40), "de", ["a", "b", "ä", None][i % 4]) for i in range(30)]
    rows += [("", "de", "wordless"), (None, "de", "wordless"), ("X y", "lone", "only"), ("é" * 3, "lone", "other")]
    docs = [(i, t, lang, source, None, 0.5, "x", 1) for i, (t, lang, source) in enumerate(rows)]
    return spark.createDataFrame(docs, DOCS).repartition(3)


@pytest.mark.parametrize("min_docs", [1, 3])
def test_messy_documents(sourced, min_docs):
    docs = [(r.lang, r.source, r.text) for r in sourced.collect()]
    assert as_rows(audit_sources(sourced, min_docs)) == audited(docs, min_docs)


def test_small_slices_parts_and_counters(sourced, monkeypatch):
    for name, value in (("SLICE_HOLDERS", 20), ("PART_BYTES", 50), ("HELD_TERMS", 30), ("MAX_BROADCAST_LANGUAGES", 0)):
        monkeypatch.setattr(source_audit, name, value)
    docs = [(r.lang, r.source, r.text) for r in sourced.collect()]
    assert as_rows(audit_sources(sourced, 2)) == audited(docs, 2)


def test_nothing(nothing, sourced):
    assert audit_sources(nothing).count() == 0
    alone = audit_sources(sourced.where("lang = 'lone'"))
    assert {(r.part, r.value) for r in alone.collect()} == {("pair", 0)}


def test_shares_do_not_overflow():
    counts, total, kept = np.array([0, 7, 4 * 10**14]), 10**15, 10**9
    expected = [1 + 1_000_000_000 * (c + 2) // (total + 2 * kept) for c in counts.tolist()]
    assert shares(counts, total, kept).tolist() == expected
    assert gaps(np.array([1_000_000_001]), np.array([1])).tolist() == [10**18 // 1_000_000_002]


def test_parts_cut_between_terms(monkeypatch):
    text = "aa bbb  " * 9 + "c" * 40 + " dd"
    whole = re.findall(r"[a-z]+", text)
    for size in range(1, 60):
        monkeypatch.setattr(source_audit, "PART_BYTES", size)
        assert [t.decode() for part in source_audit._term_lists(text.encode()) for t in part] == whole
