"""MinHash banding over padded q-grams."""

from __future__ import annotations

import math

import numpy as np
import xxhash

_P = np.uint64((1 << 61) - 1)


def collision(similarity: float, bands: int, rows: int) -> float:
    """Probability that two sets of this Jaccard similarity share a band."""
    return 1 - (1 - similarity**rows) ** bands


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """The fewest bands of ``rows`` hashes that reach ``recall`` at ``similarity``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def edit_similarity(length: int, q: int, lost: int) -> float:
    """Jaccard similarity of padded q-gram sets after an edit that replaces ``lost`` grams."""
    grams = length + q - 1
    return max(0.0, (grams - lost) / (grams + lost))


def qgrams(text: str, q: int) -> set[str]:
    padded = "\x02" * (q - 1) + text + "\x03" * (q - 1)
    return {padded[i : i + q] for i in range(len(padded) - q + 1)}


class MinHash:
    """Band hashes of a text; the hash functions are fixed by ``seed``."""

    def __init__(self, bands: int, rows: int, q: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.bands, self.rows, self.q = bands, rows, q
        self.a = rng.integers(1, 1 << 31, size=bands * rows, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 61, size=bands * rows, dtype=np.uint64)

    def keys(self, text: str) -> list[int]:
        grams = np.fromiter((xxhash.xxh32_intdigest(g) for g in qgrams(text, self.q)), dtype=np.uint64)
        mixed = (grams[:, None] * self.a[None, :] + self.b[None, :]) % _P
        least = mixed.min(axis=0).reshape(self.bands, self.rows)
        return [xxhash.xxh64_intdigest(row.tobytes(), seed=i) - (1 << 63) for i, row in enumerate(least)]


def banding(similarity: float, recall: float, most_bands: int) -> tuple[int, int]:
    """Bands and rows: the most rows a band whose number at ``recall`` stays within ``most_bands``."""
    rows = 1
    while (needed := bands_for(similarity, recall, rows + 1)) <= most_bands:
        rows += 1
    return bands_for(similarity, recall, rows), rows
