"""Anchors: content-defined sample positions at which equal passages meet.

The anchor of a window (so many consecutive symbols) is the first of its ``gram``-long runs with the smallest hash, so two
equal windows hold the same anchor at the same place. The context of an anchor is what its windows cover; every window lies in
the context of its own anchor only. Passages are compared within the contexts of one anchor, whatever else the documents share.
"""

from __future__ import annotations

import numpy as np

from txnlens.llm.common import RangeHashes, first_argmin, window_hashes


def context_anchors(symbols: np.ndarray, window: int, gram: int, hashes: RangeHashes | None = None):
    """(anchor hash, position, start, end, context hash) arrays of one document's symbol hashes (uint64).

    ``symbols[start:end]`` is the context of the anchor at ``position``. The context hash also covers the place of the anchor
    in it. A document shorter than a window has none.
    """
    n = len(symbols)
    if n < window:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    grams = window_hashes(symbols, gram)
    owner = first_argmin(grams, window - gram + 1)
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    at, end = owner[start], np.r_[start[1:], len(owner)] + window - 1
    context = (hashes or RangeHashes(symbols)).of(start, end) ^ ((at - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return grams[at].view(np.int64), at, start, end, context.view(np.int64)


def halves(hashes: RangeHashes, at: np.ndarray, start: np.ndarray, end: np.ndarray, window: int, gram: int):
    """(left, right): hashes of an anchor with half of what a window holds besides it, before and after; 0: not in the context.

    A window holds one of the two whole, so contexts that share a window share a half.
    """
    half = (window - gram + 1) // 2
    before, after = at - half >= start, at + gram + half <= end
    found = hashes.of(np.r_[np.where(before, at - half, at), at], np.r_[at + gram, np.where(after, at + gram + half, at)])
    left, right = np.split(found.view(np.int64) | 1, 2)
    return np.where(before, left, 0), np.where(after, right, 0)
