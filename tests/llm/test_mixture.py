import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martloom.llm.mixture import PLACES, cut_stream, pack_mixture, sent_pieces
from martloom.plans.shared import materialize
from tests.llm.conftest import DOCS, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def round_robin(queues, quanta, grain):
    """Deficit round-robin spelled out: (round, source, document, start, length) in the order of sending."""
    deficit, at, sent, round_ = Counter(), Counter(), [], 0
    ends = {s: np.cumsum(q).tolist() for s, q in queues.items()}
    while any(at[s] < ends[s][-1] for s in queues):
        round_ += 1
        for s in sorted(queues):
            deficit[s] += quanta[s]
            grains = deficit[s] // (grain << PLACES)
            deficit[s] -= grains * (grain << PLACES)
            stop = min(at[s] + grains * grain, ends[s][-1])
            for d, end in enumerate(ends[s]):
                begin = end - queues[s][d]
                a, b = max(begin, at[s]), min(end, stop)
                if a < b:
                    sent.append((round_, s, d, a - begin, b - a))
            at[s] = stop
    return sent


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.integers(0, 3), st.lists(st.integers(1, 90), min_size=1, max_size=8), min_size=1),
    st.integers(1, 9),
    st.lists(st.integers(1, 20 << PLACES), min_size=4, max_size=4),
)
def test_pieces_are_those_of_round_robin(queues, grain, quanta):
    # Tiny credits would make the plain version go round very often.
    quanta = [q if q > 1 << (PLACES - 2) else q + (1 << PLACES) for q in quanta]
    found = []
    for s, lengths in queues.items():
        tokens = np.array(lengths)
        doc, sent, start, length = sent_pieces(np.cumsum(tokens) - tokens, tokens, np.full(len(tokens), quanta[s]), grain)
        found += [(k, s, d, a, n) for k, d, a, n in zip(sent.tolist(), doc.tolist(), start.tolist(), length.tolist())]
    assert sorted(found) == sorted(round_robin(queues, dict(enumerate(quanta)), grain))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 70), min_size=1, max_size=20), st.sampled_from([8, 12, 32]))
def test_cuts_fill_sequences(lengths, capacity):
    length = np.array(lengths)
    piece, start, size, number, offset = cut_stream(np.cumsum(length) - length, length, int(length.sum()), capacity)
    filled = Counter()
    for s, o, n in sorted(zip(number.tolist(), offset.tolist(), size.tolist(), strict=True)):
        assert filled[s] == o and n > 0
        filled[s] += n
    assert all(n == capacity or n & (n - 1) == 0 for n in filled.values())
    assert sorted(filled) == list(range(len(filled)))
    for p, n in enumerate(lengths):
        own = sorted(zip(start[piece == p].tolist(), size[piece == p].tolist(), strict=True))
        assert [a for a, _ in own] == np.cumsum([0] + [k for _, k in own])[:-1].tolist() and sum(k for _, k in own) == n


def check(docs, rows, capacity, end_id=2):
    """Every id in one piece, sequences without gaps; returns tokens by sequence and source."""
    whole = Tokenizer.from_file(PATH)
    expected = Counter()
    for r in docs:
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, end_id]
        expected[r.doc_id, np.array(ids, dtype="<u4").tobytes()] += 1
    found = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        found[r.doc_id].append(r)
    for doc_id, pieces in found.items():
        # Documents that share an id are told apart by trying each one's pieces in order.
        for (other, ids), times in expected.items():
            if other == doc_id:
                mine = [r for r in pieces if r.doc_tokens * 4 == len(ids) and ids[4 * r.start : 4 * (r.start + r.length)] == r.ids]
                assert sum(r.length for r in mine) >= times * len(ids) // 4
        total = sum(len(ids) // 4 * n for (other, ids), n in expected.items() if other == doc_id)
        assert sum(r.length for r in pieces) == total
    assert set(found) == {d for d, _ in expected}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    shares = {}
    for number, held in sequences.items():
        at, by_source = 0, Counter()
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
            by_source[r.source] += r.length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
        shares[number] = by_source
    return shares


def test_messy_documents(messy, nothing):
    check(messy.collect(), pack_mixture(messy, PATH, capacity=256, keep_ids=True).collect(), 256)
    assert pack_mixture(nothing, PATH).count() == 0


@pytest.fixture(scope="module")
def sources(spark):
    sizes = {"big": 60, "mid": 25, "rare": 6}
    rows = [(prose(i, 30 + 17 * i % 400), s) for s, n in sizes.items() for i in range(n)]
    docs = [(i, t, "en", s, None, 0.5, "x", 1) for i, (t, s) in enumerate(rows)]
    return materialize(spark.createDataFrame(docs, DOCS).repartition(5), "mixture_sources")


def test_every_sequence_has_the_corpus_mixture(sources):
    rows = pack_mixture(sources, PATH, capacity=512, grain=4, keep_ids=True).collect()
    shares = check(sources.collect(), rows, 512)
    total = Counter()
    for held in shares.values():
        total.update(held)
    tokens = sum(total.values())
    full = [held for held in shares.values() if sum(held.values()) == 512]
    assert len(full) == tokens // 512
    for held in full[:-1]:
        for source, n in total.items():
            # A grain for the credit and one for each source by which rounds and sequences are apart.
            assert abs(held[source] - 512 * n / tokens) <= 4 * (1 + len(total))


def test_given_targets_hold_until_a_queue_is_empty(sources):
    rows = pack_mixture(sources, PATH, targets={"rare": 0.5}, capacity=256, grain=2, keep_ids=True).collect()
    shares = check(sources.collect(), rows, 256)
    rare = sum(held["rare"] for held in shares.values())
    lasting = int(rare / 128) - 1
    assert lasting > 3
    assert all(abs(shares[s]["rare"] - 128) <= 8 for s in range(lasting))
    assert all(held["rare"] == 0 for s, held in shares.items() if s > lasting + 3)
    with pytest.raises(ValueError):
        pack_mixture(sources, PATH, targets={"rare": 1.5})
