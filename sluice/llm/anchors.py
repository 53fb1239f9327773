"""Anchors of 50-byte strings: which ones stand for every window of a text.

The anchor of a window is the position of its smallest 24-byte hash (the first
of equals). Equal windows have equal anchors at the same place in them, so
windows need only be compared with windows of the same anchor string. Runs of
neighbouring windows share an anchor, about one per 13 bytes of text. A run's
*context* is what its windows cover, 76 bytes at most.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

K = 24
SEGMENT = 1 << 20  # windows handled at a time; their numbers take 24 bits
_LOW = np.uint64((1 << 24) - 1)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + (a >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(31))


@dataclass
class Runs:
    """One entry per run: its anchor, its first and last window, and two hashes."""

    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray  # of the anchor's 24 bytes
    context: np.ndarray  # of the whole context and the anchor's place in it


def runs(data: np.ndarray, ends: np.ndarray, width: int) -> Runs:
    """Runs of all windows of ``width`` bytes that lie in one document.

    ``data`` are the documents' bytes one after another, ``ends`` where they end.
    """
    parts = [_segment(data, ends, at, width) for at in range(0, max(1, len(data) - width + 1), SEGMENT)]
    return Runs(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("anchor", "first", "last", "gram", "context")))


def _segment(data: np.ndarray, ends: np.ndarray, start: int, width: int) -> Runs:
    part = data[start : start + SEGMENT + width - 1]
    n = len(part) - width + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    one = _mix(part.astype(np.uint64) + np.uint64(1), np.uint64(0x165667B19E3779F9))
    two = _mix(one[:-1], one[1:])
    four = _mix(two[:-2], two[2:])
    eight = _mix(four[:-4], four[4:])
    gram = _mix(_mix(eight[:-8], eight[8:])[:-8], eight[16:])
    key = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)
    span, reach = width - K + 1, 1
    while 2 * reach <= span:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < span:
        key = np.minimum(key[: len(key) - (span - reach)], key[span - reach :])
    anchor = (key & _LOW).astype(np.int64)

    whole = np.ones(n, bool)  # the windows that end in the document they start in
    inner = ends[(ends > start) & (ends < start + n + width - 1)] - start
    for back in range(1, width):
        at = inner - back
        whole[at[(at >= 0) & (at < n)]] = False
    windows = np.flatnonzero(whole)
    if not len(windows):
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    at = anchor[windows]
    new = np.r_[True, (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)]
    starts = np.flatnonzero(new)
    first, last = windows[starts], windows[np.r_[starts[1:] - 1, len(windows) - 1]]
    at = at[starts]

    def window_hash(p: np.ndarray) -> np.ndarray:
        found = gram[p]
        for step in range(K, width - K + 1, K):
            found = _mix(found, gram[p + step])
        return _mix(found, gram[p + width - K])

    shape = ((last - first) << 8 | (at - first)).astype(np.uint64)
    context = _mix(_mix(window_hash(first), window_hash(last)), shape)
    # Anchors have small hashes; mixed once more they spread over all values.
    return Runs(at + start, first + start, last + start, _mix(gram[at], np.uint64(0x27D4EB2F165667C5)), context)
