"""Vectorised word and shingle hashes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

# word bytes: letters, digits and everything outside ASCII; upper case folds to lower
_CLASS = np.zeros(256, dtype=np.uint8)
for _c in range(256):
    if _c >= 128 or chr(_c).isalnum():
        _CLASS[_c] = _c + 32 if 65 <= _c <= 90 else _c


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of all texts in order, and the number of the text it is in."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    low = _CLASS[data]
    inside = low != 0
    edge = np.diff(np.r_[False, inside].astype(np.int8))
    starts = np.flatnonzero(edge == 1)
    stops = np.flatnonzero(edge == -1)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = np.r_[np.uint64(0), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(low)), dtype=np.uint64)]
    h = mixed((sums[stops] - sums[starts]) * powers(_INVERSE, len(low))[starts] + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    return h, np.searchsorted(ends, starts, side="right")


def shingles(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row of the same text, and the text's number."""
    if len(words) < n:
        return words[:0], owner[:0]
    m = len(words) - n + 1
    h = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        h = mixed(h * _BASE + words[k:k + m])
    same = owner[:m] == owner[n - 1:]
    return h[same], owner[:m][same]


#: Characters of texts hashed in one array: an array takes some 40 bytes for each byte of text while it is made.
SLICE_CHARS = 500_000


def slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of at most SLICE_CHARS characters, or one longer text, each with the number of its first text."""
    at, chars = 0, 0
    for i, t in enumerate(texts):
        if i > at and chars + len(t) > SLICE_CHARS:
            yield at, texts[at:i]
            at, chars = i, 0
        chars += len(t)
    if at < len(texts):
        yield at, texts[at:]
