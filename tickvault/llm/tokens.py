"""Vectorised words and n-grams of many texts at once (numpy).

A word's 64-bit hash is a polynomial over its bytes with one random 64-bit
value per byte, read off a prefix sum; an n-gram's hash is the same polynomial
over word hashes.  So all words, or all n-grams of any length, of a run of
texts cost a few array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_STEP = 0x9E3779B97F4A7C15
_cache: dict[str, np.ndarray] = {}


def splitmix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the step and of its inverse modulo 2**64."""
    if len(_cache.get("up", ())) < n:
        m = max(n, 1 << 16)
        for key, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _cache[key] = np.cumprod(steps)
    return _cache["up"][:n], _cache["down"][:n]


def byte_tables(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: is it in a word, and its random value.

    ``plain``: words are ``[^\\x20\\x09-\\x0D]+`` unchanged; ``lower``: the same,
    A-Z lower-cased; ``alnum``: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
    after lower-casing A-Z."""
    if kind not in _cache:
        b = np.arange(256)
        upper = (b >= 65) & (b <= 90) & (kind != "plain")
        low = np.where(upper, b + 32, b)
        if kind == "alnum":
            word = (b >= 128) | ((b >= 48) & (b <= 57)) | ((low >= 97) & (low <= 122))
        else:
            word = ~((b == 32) | ((b >= 9) & (b <= 13)))
        values = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        _cache[kind], _cache[kind + "/values"] = word, np.where(word, values[low], np.uint64(0))
    return _cache[kind], _cache[kind + "/values"]


@dataclass
class Words:
    """Words of a run of texts: text d has those from off[d] to off[d + 1];
    start and end are byte positions in the run."""

    off: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def words_of(raw: np.ndarray, offsets: np.ndarray, kind: str) -> Words:
    is_word, values = byte_tables(kind)
    inside = is_word[raw]
    before = np.empty(len(raw) + 1, bool)
    before[0] = False
    before[1:] = inside
    edge = offsets[:-1][np.diff(offsets) > 0]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = inside
    after[edge] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):  # prefix sums over about a megabyte at a time
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 20), "right")))
        a, z = int(starts[lo]), int(ends[hi - 1])
        up, down = powers(z - a + 1)
        total = np.zeros(z - a + 1, np.uint64)
        np.cumsum(values[raw[a:z]] * up[:-1], out=total[1:])
        s = starts[lo:hi] - a
        out[lo:hi] = splitmix((total[ends[lo:hi] - a] - total[s]) * down[s])
        lo = hi
    return Words(np.searchsorted(starts, offsets), starts, ends, out)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words (they may cross texts; see inside())."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for lo in range(0, n, 1 << 20):
        hi = min(n, lo + (1 << 20))
        up, down = powers(hi - lo + k)
        total = np.zeros(hi - lo + k, np.uint64)
        np.cumsum(hashes[lo:hi + k - 1] * up[:hi - lo + k - 1], out=total[1:])
        out[lo:hi] = splitmix((total[k:hi - lo + k] - total[:hi - lo]) * down[:hi - lo] + np.uint64(k))
    return out


def inside(off: np.ndarray, k: int) -> np.ndarray:
    """For each word position of grams(): does the run stay in its text?"""
    n = int(off[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(off[1:], np.diff(off))[:n]
    return np.arange(n) + k <= last
