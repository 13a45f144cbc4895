"""Lines against all pairs of documents; languages with few texts or none."""

import random

import numpy as np

from martloom.llm import langid
from martloom.llm.line_dedup import MIN_BLOCK_CHARS, line_dedup, patience, without_spans
from tests.llm.conftest import prose


def against_all_pairs(texts):
    filled = {i: [x for x in t.split("\n") if x] for i, t in texts.items()}
    out = {}
    for i, own in filled.items():
        spans = []
        for k in sorted(filled):
            if k < i:
                numbers = {v: n for n, v in enumerate({*filled[k], *own})}
                for _, j, n in patience([numbers[v] for v in filled[k]], [numbers[v] for v in own]):
                    if sum(map(len, own[j : j + n])) >= MIN_BLOCK_CHARS:
                        spans.append(np.array([[j, j + n]], dtype="<u4").tobytes())
        out[i] = without_spans(texts[i], spans)[0]
    return out


def test_lines_held_singly_by_earlier_documents(spark):
    """Exact copies in another order than the first holder's, and passages of short lines spread over earlier texts."""
    long = [prose(i, 12) for i in range(6)]
    short = [f"short line {i} of a passage" for i in range(4)]
    texts = {
        1: f"{long[0]}\n{long[1]}",
        2: f"{long[1]}\n{long[0]}",
        3: f"{long[1]}\n{long[0]}",
        **{10 + i: f"{prose(50 + i, 9)}\n{line}\n{prose(60 + i, 9)}" for i, line in enumerate(short)},
        20: "\n".join([prose(70, 9), *short, prose(71, 9)]),
        21: "\n".join([prose(72, 9), *short, prose(73, 9)]),
        22: "\n".join([prose(74, 9), *short[:3], prose(75, 9)]),
    }
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == against_all_pairs(texts)
    assert got[3] == "" and got[21] == f"{prose(72, 9)}\n{prose(73, 9)}"


def test_random_passages_of_short_lines(spark):
    """Short lines are shared by many texts, passages of them by few."""
    rng = random.Random(4)
    lines = [f"line {i:02d} of many" for i in range(60)]
    passages = [rng.sample(lines, 5) for _ in range(6)]
    texts = {}
    for i in range(60):
        own = [rng.choice(lines), prose(i, 9), *rng.choice(passages), prose(100 + i, 9), rng.choice(lines)]
        texts[i] = "\n".join(own)
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == against_all_pairs(texts)


def test_patience_without_unique_lines():
    assert patience([1, 2, 3], [9, 1, 2, 3, 8, 1, 2, 3, 7]) == [(0, 1, 3)]


def test_a_language_of_many_copies_is_learned(spark):
    """Every language keeps min(400, its different texts) rows, however many copies there are."""
    rows = [("one copied text", f"l{k}") for k in range(20) for _ in range(1500)]
    rows = [(f"{t} {lang}", lang) for t, lang in rows] + [(f"few {i} {k}", f"l{k}") for k in range(20) for i in range(5)]
    sample = langid._sample(spark.createDataFrame(rows, "text string, lang string"), 400).collect()
    assert sorted((r.lang, r.text) for r in sample) == sorted({(lang, t) for t, lang in rows})


def test_documents_stay_when_no_language_was_learned(messy):
    model = langid.train(messy.where("false"))
    kept = [r.text for r in langid.keep_identified(messy, model).collect()]
    assert len(kept) == 13 and all(t and any(c.isalpha() for c in t) for t in kept)
