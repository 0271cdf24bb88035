"""Words of texts and their hashes, in numpy over many texts at once.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased.
"""

from __future__ import annotations

import numpy as np

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers of the polynomial hash over bytes and of that over words, and of the final mixing.
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_INVERSE = pow(_BYTE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mixed(hashes: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64 bits that scatters well."""
    h = hashes + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _bounds(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and start, stop of each word, and the number of words of each text."""
    parts = [(t or "").encode() for t in texts]
    codes = _FOLD[np.frombuffer(b" ".join(parts) + b" ", np.uint8)]
    gap = _GAP[codes]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
    starts, stops = edge[0::2], edge[1::2]
    ends = np.cumsum([len(p) + 1 for p in parts])
    return codes, starts, stops, np.diff(np.searchsorted(starts, ends), prepend=0)


def count_words(texts: list) -> int:
    return len(_bounds(texts)[1]) if texts else 0


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, in order, and the number of words of each text."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, starts, stops, n = _bounds(texts)
    # Prefix sums of byte times power: a word's hash is the difference, brought back to power 0, and
    # depends on its length too.
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(_BYTE, len(codes)), out=sums[1:])
    back = _powers(_INVERSE, len(codes) + 1)[starts]
    return mixed((sums[stops] - sums[starts]) * back + (stops - starts).astype(np.uint64)), n


def joined_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k words in a row."""
    if len(hashes) < k:
        return hashes[:0]
    out = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(_WORD) + mixed(hashes[i : len(hashes) - k + 1 + i], i)
    return out
