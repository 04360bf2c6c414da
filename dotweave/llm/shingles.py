"""Word-shingle sets of texts, computed on Arrow buffers with numpy.

Words are the runs between ASCII white space of the lower-cased text (Spark's
``lower``, applied by the callers). A shingle is ``WORDS`` consecutive words; a
text of fewer words, but one, is a single shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

WORDS = 5
_P = np.uint64(0x100000001B3 * 2 + 0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_C = np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes handled at once, where a text is no longer.
SLAB = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n + 1:
        n = max(n, SLAB)
        _POWERS[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, p))]) for p in (_P, _P_INV)]
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the text that it is in."""
    n = len(data)
    space = np.ones(n + 2, bool)
    space[1:-1] = _SPACE[data]
    turn = space[1:] != space[:-1]  # turn[i]: between byte i - 1 and byte i
    inside = offsets[1:-1]
    inside = inside[(inside > 0) & (inside < n)]
    inside = np.unique(inside[~space[inside] & ~space[inside + 1]])  # texts that meet within a run
    edges = np.flatnonzero(turn)
    starts, ends = edges[::2], edges[1::2]
    if len(inside):
        starts, ends = np.union1d(starts, inside), np.union1d(ends, inside)
    up, down = _powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * up[:n])])
    words = mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(offsets, starts, "right") - 1


def _slab_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, doc = word_hashes(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(doc, minlength=n)
    h = np.zeros(0, np.uint64)
    owner = np.zeros(0, np.int64)
    if len(words) >= WORDS:
        h = words[: len(words) - WORDS + 1].copy()
        for k in range(1, WORDS):
            h = h * _C + words[k : len(words) - WORDS + 1 + k]
        whole = doc[: len(h)] == doc[WORDS - 1 :]
        h, owner = h[whole], doc[: len(whole)][whole]
    few = np.flatnonzero((count > 0) & (count < WORDS))
    if len(few):
        first = np.cumsum(count) - count
        short = np.full(len(few), 0x5851F42D4C957F2D, np.uint64)
        for k in range(WORDS - 1):
            has = count[few] > k
            short[has] = short[has] * _C + words[first[few[has]] + k]
        h, owner = np.concatenate([h, short]), np.concatenate([owner, few])
    key = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (mix64(h) >> np.uint64(16)))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key & np.uint64((1 << 48) - 1), np.bincount((key >> np.uint64(48)).astype(np.int64), minlength=n)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 48-bit shingle hashes of each text, ascending, one text after another; and their numbers."""
    values, counts, at, n = [], [], 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + SLAB, "right")) - 1
        to = min(max(to, at + 1), at + 60_000, n)
        v, c = _slab_sets(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        values.append(v)
        counts.append(c)
        at = to
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(values), np.concatenate(counts)
