import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm.bpe import ByteBpe, encode_decode, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = read_ranks(PATH)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ByteBpe(ranks, public_tokenizers.PATTERN), plain


def ids_of(bpe, text):
    raw = bpe.encode([text])[0]
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aAbtheé日 \n\t'0s.,́"), max_size=60))
def test_same_as_the_library(both, text):
    bpe, plain = both
    assert ids_of(bpe, text) == plain.encode_ordinary(text)
    assert bpe.decode(bpe.encode([text])[0]) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 900, "x" * 256, "x" * 257, " " * 700 + "y", "日本" * 400])
def test_long_matches(both, text):
    bpe, plain = both
    assert ids_of(bpe, text) == plain.encode_ordinary(text)


def test_messy_documents(messy, nothing, both):
    rows = encode_decode(messy, PATH, public_tokenizers.PATTERN).collect()
    got = sorted((r.decoded_sha256, r.n_tokens) for r in rows)
    texts = [r.text or "" for r in messy.collect()]
    assert got == sorted((hashlib.sha256(t.encode()).hexdigest(), len(both[1].encode_ordinary(t))) for t in texts)
    assert encode_decode(nothing, PATH, public_tokenizers.PATTERN).count() == 0
