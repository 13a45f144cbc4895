"""Token ids of a BPE vocabulary with word ends, for many texts at a time.

Such a tokenizer drops white space, lower-cases and cuts texts into runs of letters,
single digits and runs of marks. Whatever stands between blanks is therefore encoded
once and remembered; Arrow finds the different chunks of a batch, and numpy puts
their ids together. Runs of plain letters or marks go to a byte-pair encoder by rank
in which a zero byte closes a word; everything else goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Chunks remembered in each of two generations, and characters of a text encoded at a time.
MAX_CACHED_WORDS = 150_000
PART_CHARS = 4 << 20


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level vocabularies write for bytes: printable bytes stand for themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


def _parts(text: str) -> Iterator[str]:
    """The text cut at blanks into parts of about ``PART_CHARS``."""
    start = 0
    while len(text) - start > PART_CHARS:
        cut = text.find(" ", start + PART_CHARS)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


class WordTokenizer:
    """Ids of a tokenizer file, remembered by chunk."""

    # Marks that may follow a word; not the apostrophe, which starts endings.
    _MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
    # Beyond these letters, composition of marks may change a word.
    _COMPOSED = re.compile(r"[^\x00-\xff]").search
    # Beyond these letters, lower-casing may depend on what stands around them.
    _FOREIGN = re.compile(r"[^\x00-ɏ]").search

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        model = json.loads(self.whole.to_str())["model"]
        suffix = model["end_of_word_suffix"]
        octets = {chr(letter): byte for byte, letter in _byte_letters().items()}
        octets |= {chr(b): b for b in range(256) if b not in _byte_letters()}

        def spelled(token: str) -> bytes:
            ends = token.endswith(suffix)
            return bytes(octets[c] for c in (token.removesuffix(suffix) if ends else token)) + b"\0" * ends

        # A letter with the end of its word is a symbol of its own, so these pairs come before all merges.
        order = [bytes([b]) for b in range(256)] + [bytes([b, 0]) for b in range(256)]
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            order.append(spelled(left) + spelled(right))
        special = {token.content for token in self.whole.get_added_tokens_decoder().values()}
        ids = {spelled(token): i for token, i in model["vocab"].items() if token not in special}
        self.ids_by_rank = np.array([ids[token] for token in order], dtype="<u4")
        self.closes = np.array([len(token) > 1 and token.endswith(b"\0") for token in order])
        self.encoder = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks={t: i for i, t in enumerate(order)}, special_tokens={}
        )
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _learn_words(self, words: list[str]) -> None:
        """Ids of words; the last token of each, and no other, closes a word."""
        ranks = self.encoder.encode_to_numpy("\0".join(words) + "\0", disallowed_special=())
        ends = ((np.flatnonzero(self.closes[ranks]) + 1) * 4).tolist()
        raw, start = self.ids_by_rank[ranks].tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            self.known[word] = raw[start:end]
            start = end

    def _learn(self, chunks: list[str]) -> None:
        """Ids of new chunks: a word with marks after it is put together, others pass through the whole tokenizer."""
        known, marks = self.known, self._MARKS
        lowered = [c.lower() if c.isascii() or not self._FOREIGN(c) else c for c in chunks]
        words = [c.rstrip(marks) for c in lowered]
        plain = [w.isalpha() and (w.isascii() or not self._COMPOSED(w)) for w in words]
        new = set(compress(words, plain))
        new.update([c[len(w) :] for c, w in compress(zip(lowered, words, strict=True), plain) if c is not w])
        new = [w for w in new if w not in known]
        if new:
            self._learn_words(new)
        for chunk, low, word in compress(zip(chunks, lowered, words, strict=True), plain):
            if chunk not in known:
                known[chunk] = known[word] + known[low[len(word) :]]
        other = [c for c, p in zip(chunks, plain, strict=True) if not p]
        if other:
            for chunk, found in zip(other, self.whole.encode_batch_fast(other, add_special_tokens=False), strict=True):
                known[chunk] = np.array(found.ids, dtype="<u4").tobytes()

    def _recall(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks; those used lately stay known."""
        if len(self.known) > MAX_CACHED_WORDS:
            self.older, self.known = self.known, {"": b""}
        known, older = self.known, self.older
        new = [c for c in chunks if c not in known]
        if new:
            known.update({c: older[c] for c in new if c in older})
            unseen = [c for c in new if c not in known]
            if unseen:
                self._learn(unseen)
        return [known[c] for c in chunks]

    def _encode(self, texts: list[str]) -> list[bytes]:
        lowered = [t if not t.isascii() and self._FOREIGN(t) else t.lower() for t in texts]
        split = pc.split_pattern(pa.array([t.replace("\n", " ") for t in lowered], pa.large_string()), " ")
        chunks = split.flatten().dictionary_encode()
        found = self._recall(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        at = chunks.indices.to_numpy()
        lengths = sizes[at]
        ends = np.cumsum(lengths)
        begins = (np.cumsum(sizes) - sizes)[at]
        ids = pool[np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; long texts part by part."""
        if not any(len(t) > PART_CHARS for t in texts):
            return self._encode(texts)
        return [
            self._encode([t])[0] if len(t) <= PART_CHARS else b"".join(self._encode([p])[0] for p in _parts(t))
            for t in texts
        ]
