"""Byte n-grams of many texts at once."""

from __future__ import annotations

import numpy as np

#: Two bytes are one code; three bytes are hashed to as many codes again.
PAIRS = 1 << 16
CODES = 2 * PAIRS

#: Lower-case letters; every other ASCII byte is a space.
LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def codes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the two- and three-byte grams that lie within one text, and
    the text's number for each."""
    if len(raw) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    wide = raw.astype(np.int64)
    two = wide[:-1] << 8 | wide[1:]
    in_two = (doc[:-1] == doc[1:]) & (two != 0x2020)
    three = PAIRS + (((two[:-1] << 8 | wide[2:]) * 2654435761 >> 7) & (PAIRS - 1))
    in_three = (doc[:-2] == doc[2:]) & (two[:-1] != 0x2020) & (two[1:] != 0x2020)
    return np.concatenate([two[in_two], three[in_three]]), np.concatenate([doc[:-1][in_two], doc[:-2][in_three]])


def mean_weights(code: np.ndarray, doc: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each text's grams, for each column of ``weights`` (codes x columns)."""
    size = np.maximum(np.bincount(doc, minlength=n), 1)
    return np.stack([np.bincount(doc, weights=w[code], minlength=n) / size for w in weights.T], axis=1) if weights.shape[1] else np.zeros((n, 0))
