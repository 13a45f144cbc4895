import zlib
from functools import cache

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martloom.llm import word_ids
from martloom.llm.packing import exact_patterns, pack_documents, plan_packing
from martloom.llm.word_ids import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_plan(histogram, capacity):
    """Every piece once, sequences without gaps or overlaps; returns the number of sequences."""
    plan = plan_packing(histogram, capacity)
    filled, ranks = {}, {}
    for length, rank, count, base, offset in plan.tolist():
        for i in range(count):
            filled.setdefault(base + i, []).append((offset, length))
            ranks.setdefault(length, []).append(rank + i)
    assert {k: len(v) for k, v in ranks.items()} == {k: v for k, v in histogram.items() if v}
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=20))
def test_plan_places_every_piece_once(histogram):
    sequences = check_plan(histogram, 64)
    total = sum(k * v for k, v in histogram.items())
    # First-fit-decreasing bounds hold for a plan that ends best-fit decreasing.
    assert sequences >= -(-total // 64)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(5)
    lengths = np.minimum(rng.lognormal(5.5, 1, 20_000).astype(int) + 1, 1024)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True), strict=True)}
    assert check_plan(histogram, 1024) <= 1.002 * lengths.sum() / 1024 + 1


def test_patterns_fill_exactly():
    rows = {tuple(r) for r in exact_patterns(np.array([1, 2, 3, 5, 8]), 8).tolist()}
    assert rows == {(8, 0, 0), (5, 3, 0), (5, 2, 1), (3, 3, 2)}


def test_ids_are_the_tokenizers():
    tokenizer, whole = WordTokenizer(PATH), Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    texts = ["It's, well.. I'LL (don't) 3.14_x", "ẞ ß ſ K İ é́", "a.b,c.,d", "", " x\n\n\ty ", "<|endoftext|>", "été,ÊTRE."]
    for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@cache
def _tokenizers():
    return WordTokenizer(PATH), Tokenizer.from_file(PATH)


words = st.text(alphabet="abhinorstxyzéñüßÉA012.,!$_'-\n ", max_size=40)


@settings(max_examples=80, deadline=None)
@given(st.lists(words, max_size=6))
def test_ids_of_any_chunks(texts):
    tokenizer, whole = _tokenizers()
    for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_vocabulary_encodes_to_itself():
    """Every token is what its own letters merge to, which ranks of whole tokens rely on."""
    tokenizer, whole = WordTokenizer(PATH), Tokenizer.from_file(PATH)
    spelled = [t.removesuffix("</w>") for t in whole.get_vocab() if t.endswith("</w>")]
    plain = [t for t in spelled if t.isalpha() and t.isascii() and t.islower()]
    assert len(plain) > 10_000
    ids = tokenizer.encode([" ".join(plain)])[0]
    assert np.frombuffer(ids, "<u4").tolist() == [whole.token_to_id(t + "</w>") for t in plain]


def test_long_texts_and_forgotten_words(monkeypatch):
    whole, text = Tokenizer.from_file(PATH), "abc, déf! " * 400 + "End."
    monkeypatch.setattr(word_ids, "PART_CHARS", 37)
    monkeypatch.setattr(word_ids, "MAX_CACHED_WORDS", 2)
    tokenizer = WordTokenizer(PATH)
    for _ in range(2):
        ids = tokenizer.encode([text, "x" * 100, "Wort"])
        assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [
            whole.encode(t, add_special_tokens=False).ids for t in (text, "x" * 100, "Wort")
        ]


def test_messy_documents(messy, nothing):
    whole = Tokenizer.from_file(PATH)
    rows = pack_documents(messy, PATH, capacity=256, keep_ids=True).collect()
    texts = [(r.doc_id, r.text or "") for r in messy.collect()]
    expected = []
    for doc_id, text in texts:
        ids = [*whole.encode(text, add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at : at + 256], dtype="<u4").tobytes()
            expected.append((doc_id, k, at, len(part) // 4, zlib.crc32(part)))
    key = lambda t: [(v is None, v) for v in t]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(expected, key=key)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 256
    assert pack_documents(nothing, PATH).count() == 0
