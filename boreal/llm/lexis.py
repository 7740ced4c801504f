"""Words, word sets and MinHash on Arrow batches, shared by the operators of this package.

A word is a maximal run of letters and digits after NFKC and lower-casing; every other character separates
words. Words travel as 64-bit hashes, so sets are compared without their strings.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """NFKC and lower case."""
    if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return text.lower()


def words(text: str | None) -> list[str]:
    """The words of a text; null has none."""
    return _WORD.findall(fold(text)) if text else []


class WordHashes(dict):
    """word -> signed 64-bit hash, kept per worker and emptied when it grows beyond ``most`` words."""

    def __init__(self, most: int = 2_000_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        self[word] = value
        return value


HASHES = WordHashes()


def word_set(text: str | None) -> np.ndarray:
    """Sorted distinct word hashes."""
    own = set(words(text))
    out = np.fromiter((HASHES[w] for w in own), np.int64, len(own))
    out.sort()
    return out


def set_key(values: np.ndarray) -> bytes:
    """128 bits that stand for a set of words."""
    return xxhash.xxh3_128_digest(values.tobytes())


def _columns(sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sets of like size as the columns of a matrix of 32-bit words, filled up with their own first value."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        least = int(sizes[order[at]])
        upto = int(np.searchsorted(sizes[order], max(least * 5 // 4, least + 4), side="right"))
        upto = min(upto, at + max(1, 400_000 // max(least, 1)))
        own = order[at:upto]
        height = int(sizes[own[-1]])
        out = np.empty((height, len(own)), np.uint32)
        for c, i in enumerate(own):
            mixed = sets[i].astype(np.int64).view(np.uint64)
            mixed = ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            out[: len(mixed), c] = mixed
            out[len(mixed) :, c] = mixed[0]
        yield own, out
        at = upto


def minhash(sets: list[np.ndarray], count: int, seed: int = 7) -> np.ndarray:
    """``count`` MinHash values (uint32) of each non-empty set, as a matrix of sets x count."""
    rng = np.random.default_rng(seed)
    mult = rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    add = rng.integers(0, 1 << 32, count, dtype=np.uint32)
    out = np.empty((count, len(sets)), np.uint32)
    for own, words_ in _columns(sets):
        buffer = np.empty_like(words_)
        for k in range(count):
            np.multiply(words_, mult[k], out=buffer)
            buffer += add[k]
            out[k, own] = buffer.min(axis=0)
    return out.T


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` MinHash values; bands never share keys but by accident."""
    bands = values.shape[1] // rows
    out = np.empty((values.shape[0], bands), np.int64)
    for b in range(bands):
        key = np.full(values.shape[0], np.uint64(0x9E3779B97F4A7C15 * (b + 1) & 0xFFFFFFFFFFFFFFFF))
        for r in range(rows):
            key = (key ^ values[:, b * rows + r].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(33)
        out[:, b] = key.view(np.int64)
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two sorted arrays of distinct hashes; two empty sets have none."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 0.0


def overlaps(left: Iterable[np.ndarray], right: Iterable[np.ndarray]) -> np.ndarray:
    """Jaccard of each pair of sorted arrays, in one vectorised pass over the batch."""
    left, right = list(left), list(right)
    if not left:
        return np.zeros(0)
    na, nb = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    n = len(left)
    row = np.concatenate([np.repeat(np.arange(n), na), np.repeat(np.arange(n), nb)])
    val = np.concatenate([*left, *right]).astype(np.int64)
    order = np.lexsort((val, row))
    row, val = row[order], val[order]
    same = (row[1:] == row[:-1]) & (val[1:] == val[:-1])
    both = np.bincount(row[1:][same], minlength=n)
    either = na + nb - both
    return np.divide(both, either, out=np.zeros(n), where=either > 0)
