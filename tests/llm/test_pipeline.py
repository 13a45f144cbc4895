"""The whole pipeline against a plain version in one process."""

import zlib

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

import corpus_pipeline
from martloom.llm import line_dedup
from tests.conftest import SMALL
from tests.llm.test_dedup import plain_print, union_find


def plain_lines(texts):
    filled = {i: [x.strip() for x in t.split("\n") if x.strip()] for i, t in texts.items()}
    first = {}
    for i in sorted(filled):
        for line in filled[i]:
            first.setdefault(line, i)
    out = {}
    for i, own in filled.items():
        spans = []
        for k in {first[line] for line in own} - {i}:
            numbers = {v: n for n, v in enumerate({*filled[k], *own})}
            for _, j, n in line_dedup.patience([numbers[v] for v in filled[k]], [numbers[v] for v in own]):
                if sum(map(len, own[j : j + n])) >= line_dedup.MIN_BLOCK_CHARS:
                    spans.append(np.array([[j, j + n]], dtype="<u4").tobytes())
        out[i] = line_dedup.without_spans(texts[i], spans)[0]
    return out


def plain_near_copies(texts):
    ids = sorted(texts)
    prints = np.array([plain_print(texts[i]) for i in ids], dtype=np.uint64)
    pairs = [(k, int(j)) for k in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[k]) <= 4)]
    root = union_find(len(ids), pairs)
    return {i: texts[i] for k, i in enumerate(ids) if root[k] == k}


def plain_substrings(texts, length=100):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = texts[i].encode()
        covered = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(raw[s : s + length])
        out[i] = bytes(x for x, c in zip(raw, covered, strict=True) if not c).decode(errors="ignore")
    return out


def plain_pieces(texts, capacity=4096):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    out = []
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out)


def test_run_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    texts = {r.doc_id: r.text for r in docs if r.text and regex.search(r"\p{L}", r.text)}
    expected = plain_pieces(plain_substrings(plain_near_copies(plain_lines(texts))))
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(held) <= -(-sum(r.length for r in rows) // 4096) + 1
