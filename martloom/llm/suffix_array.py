"""Suffix arrays of byte shards by induced sorting, and permuted common prefixes.

Everything here is numpy on one shard. Induction goes through the alphabet
bucket by bucket; all suffixes that a bucket induces are placed at once.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour (S-type); the last is the sentinel."""
    n = len(s)
    small = np.zeros(n, dtype=bool)
    small[-1] = True
    # A suffix has the type of the next place where the symbol changes.
    change = np.flatnonzero(s[:-1] != s[1:])
    rising = s[change] < s[change + 1]
    at = np.searchsorted(change, np.arange(n - 1))
    inside = at < len(change)
    small[:-1][inside] = rising[at[inside]]
    return small


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """Suffix array from the leftmost-smaller suffixes ``lms``, in the order given within each bucket."""
    n = len(s)
    counts = np.bincount(s, minlength=size)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(n, -1, dtype=np.int32)
    symbols = s[lms]
    seeds_at = np.searchsorted(symbols, np.arange(size + 1))  # lms come sorted by their first symbol

    def deal(batch: np.ndarray, wanted_small: bool, heads: np.ndarray) -> np.ndarray:
        """Put the left neighbours of ``batch`` that have the wanted type; their symbols, for the bucket at hand."""
        left = batch[batch > 0] - 1
        left = left[small[left] == wanted_small]
        if not len(left):
            return left
        to = s[left]
        order = np.argsort(to, kind="stable")
        left, to = left[order], to[order]
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        each = np.diff(np.concatenate([first, [len(to)]]))
        rank = np.arange(len(to)) - np.repeat(first, each)
        buckets = to[first]
        if wanted_small:
            sa[np.repeat(heads[buckets], each) - 1 - rank] = left
            heads[buckets] -= each
        else:
            sa[np.repeat(heads[buckets], each) + rank] = left
            heads[buckets] += each
        return left

    heads = starts.copy()
    for c in np.flatnonzero(counts):
        done = starts[c]
        while done < heads[c]:  # L-type suffixes of this bucket, some induced by others in it
            batch, done = sa[done : heads[c]], heads[c]
            deal(batch, False, heads)
        deal(lms[seeds_at[c] : seeds_at[c + 1]], False, heads)
    large_ends = heads
    tails = ends.copy()
    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c]
        while done > tails[c]:
            batch, done = sa[tails[c] : done][::-1], tails[c]
            deal(batch, True, tails)
        deal(sa[starts[c] : large_ends[c]][::-1], True, tails)
    sa[0] = n - 1
    return sa


def _named(s: np.ndarray, order: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether each leftmost-smaller substring of ``order`` differs from the one before it."""
    left, right = order[:-1], order[1:]
    differs = lengths[left] != lengths[right]
    at, k = np.flatnonzero(~differs), 0
    while len(at):
        same = s[left[at] + k] == s[right[at] + k]
        differs[at[~same]] = True
        at, k = at[same], k + 1
        at = at[k < lengths[left[at]]]
    return np.concatenate([[True], differs])


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string with a wide alphabet: only ties are sorted again, by twice the length."""
    n = len(names)
    sa = np.argsort(names, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    fresh = np.concatenate([[True], names[sa][1:] != names[sa][:-1]])
    rank[sa] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    step = 1
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return sa
        rows = sa[at]
        following = rows + step
        second = np.where(following < n, rank[np.minimum(following, n - 1)], -1)
        order = np.lexsort((second, rank[rows]))
        sa[at] = rows[order]
        first, second = rank[rows][order], second[order]
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        fresh[at] = new
        start = np.maximum.accumulate(np.where(new, at, 0))
        rank[sa[at]] = start
        step *= 2


def suffix_array(s: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of ``s``, symbols 1 .. ``size`` - 1 followed by one 0.

    Leftmost-smaller (LMS) suffixes start S-type runs. Induction from their first
    symbols sorts the substrings between them; their names form a shorter string,
    whose suffixes give the order of the LMS suffixes, from which all others are
    induced. The shorter string is sorted in the same way while its alphabet is
    narrow enough to go through by buckets, and by doubling otherwise.
    """
    n = len(s)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) < 2:
        return _induce(s, small, lms, size)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    lengths = np.zeros(n, dtype=np.int32)
    lengths[lms[:-1]] = np.diff(lms) + 1
    lengths[lms[-1]] = 1
    by_symbol = lms[np.argsort(s[lms], kind="stable")]
    rough = _induce(s, small, by_symbol, size)
    order = rough[is_lms[rough]]
    names = np.empty(n, dtype=np.int32)
    names[order] = np.cumsum(_named(s, order, lengths)) - 1
    shorter = names[lms]
    width = int(shorter.max()) + 1
    if width == len(lms):
        ranked = np.empty(len(lms), dtype=np.int64)
        ranked[shorter] = lms
    else:
        inner = suffix_array(shorter, width) if width <= 1024 else _by_doubling(shorter)
        ranked = lms[inner]
    return _induce(s, small, ranked, size)


def permuted_common_prefixes(octets: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each position, bytes in common with its predecessor in the suffix array, counted to ``limit``.

    Positions are taken in text order: where the one before has more than
    ``limit`` bytes in common with its predecessor, this one has ``limit`` and
    needs no look. Others are compared eight bytes at a time.
    """
    n = len(sa)
    before = np.full(n, -1, dtype=np.int32)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([octets, np.zeros(limit + 8, dtype=np.uint8)])
    words = np.zeros(n + limit, dtype=np.uint64)
    for k in range(8):
        words |= padded[k : k + n + limit].astype(np.uint64) << np.uint64(8 * k)
    common = np.zeros(n, dtype=np.int32)
    at = np.flatnonzero(before >= 0)
    for k in range(0, limit, 8):
        step = min(k, limit - 8)
        same = words[at + step] == words[before[at] + step]
        at = at[same]
        common[at] = step + 8
    return common
