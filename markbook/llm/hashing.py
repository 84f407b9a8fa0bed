"""Word and shingle hashes of whole texts in numpy; all arithmetic is modulo 2^64."""

from __future__ import annotations

import numpy as np

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_KEPT = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
_SHINGLE = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: a bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1)."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word, a run of bytes other than white space."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(text: str | None) -> np.ndarray:
    """A hash for each word of the text, A-Z in lower case; none for a missing text."""
    return hashes_and_spans(text)[0]


def hashes_and_spans(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, word starts and ends, and the lower-cased bytes they refer to."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(LOWER), np.uint8)
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends, data
    up, down = _both_powers(len(data) + 1)
    # sums of byte times power up to each place; a word's own sum is moved to power 0
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=upto[1:])
    sums = (upto[ends] - upto[starts]) * down[starts]
    return mix(sums + (ends - starts).astype(np.uint64) * _SHINGLE[0]), starts, ends, data


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next text."""
    if len(_KEPT[0]) < n:
        size = 1 << (n - 1).bit_length()
        _KEPT[:] = [powers(_BASE, size), powers(_INVERSE, size)]
    return _KEPT[0], _KEPT[1]


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash for each run of ``size`` words, or one for all words where there are fewer; none without words."""
    n = len(words)
    if n == 0:
        return words
    take = min(n, size)
    total = np.zeros(n - take + 1, np.uint64)
    for j in range(take):
        total = total * _SHINGLE[1] + words[j : n - take + 1 + j]
    return mix(total ^ np.uint64(take))


def set_hash(members: np.ndarray) -> int:
    """One signed 64-bit hash of a set of hashes, whatever their order."""
    total = np.add.reduce(mix(members ^ _SHINGLE[2]), dtype=np.uint64, keepdims=True)
    return int(mix(total ^ (np.full(1, len(members), np.uint64) * _SHINGLE[3])).view(np.int64)[0])
