"""Words and shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import byte_view, mix64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def parts(column: pa.Array, most: int = 1 << 22, rows: int = 1000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The bytes of a column in runs of whole texts: (first, last + 1, bytes,
    offsets), about ``most`` bytes and at most ``rows`` texts each."""
    raw, at = byte_view(column)
    first = 0
    while first < len(at) - 1:
        last = min(max(int(np.searchsorted(at, at[first] + most, "right")) - 1, first + 1), first + rows, len(at) - 1)
        yield first, last, raw[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each white-space word, A-Z lowered, and its text's number."""
    word, begin = word_spans(raw, at)
    return word, np.searchsorted(at, begin, "right") - 1


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each white-space word, A-Z lowered, and the place where it begins."""
    inside = ~SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][np.diff(at) > 0]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    here = np.flatnonzero(inside)
    word = np.cumsum(first[here]) - 1
    place = here - starts[word]
    powers = np.ones(int(place.max()) + 1, np.uint64)
    powers[1:] = _FACTOR
    powers = np.multiply.accumulate(powers)
    values = _BYTE[LOWER[raw[here]]] * powers[place]
    begins = np.flatnonzero(first[here])
    return mix64(np.add.reduceat(values, begins)), starts


def shingles(words: np.ndarray, doc: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words within a text, and the text's
    number, in the order of the text.  A text of fewer words has one shingle
    of them all; a text without words has none."""
    n = len(words)
    if not n:
        return words, doc
    total = np.zeros(max(n - size + 1, 0), np.uint64)
    for j in range(size):
        total = total * _FACTOR + words[j:n - size + 1 + j] if len(total) else total
    whole = doc[:len(total)] == doc[size - 1:size - 1 + len(total)]
    begins = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    count = np.diff(np.r_[begins, n])
    extra_s, extra_d = [], []
    for b, c in zip(begins[count < size], count[count < size], strict=True):
        h = np.full(1, c, np.uint64)
        for w in words[b:b + c]:
            h = h * _FACTOR + w
        extra_s.append(h[0])
        extra_d.append(doc[b])
    s = np.concatenate([total[whole], np.array(extra_s, np.uint64)])
    d = np.concatenate([doc[:len(total)][whole], np.array(extra_d, np.int64)])
    order = np.argsort(d, kind="stable") if extra_s else slice(None)
    return mix64(s[order]), d[order]


def weighted(s: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text (below 1024 texts): 54-bit hash, text, count."""
    key = np.sort(d.astype(np.uint64) << np.uint64(54) | s >> np.uint64(10))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(key)])
    key = key[first]
    return key & np.uint64((1 << 54) - 1), (key >> np.uint64(54)).astype(np.int64), count
