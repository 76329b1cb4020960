"""Distinct word shingles and MinHash signatures of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from tessera.llm.words import Words, mix, slices, window_hashes, window_starts

SHINGLE_WORDS = 5


def shingle_hashes(words: Words, length: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text in order, and where each text's begin. A text of fewer words than a shingle
    has one shingle, all its words; a text without words has none."""
    hashes = words.hashes()
    starts, counts = window_starts(words.first, length)
    found = window_hashes(hashes, starts, length)
    short = np.flatnonzero((words.counts() > 0) & (words.counts() < length))
    if not len(short):
        return found, np.append(0, np.cumsum(counts))
    ends = np.cumsum(counts)
    whole = []
    for i in short:
        n = words.first[i + 1] - words.first[i]
        whole.append(mix(window_hashes(hashes[words.first[i] : words.first[i + 1]], np.zeros(1, dtype=np.int64), n) + np.uint64(n))[0])
    found = np.insert(found, ends[short], np.array(whole, dtype=np.uint64))
    counts[short] = 1
    return found, np.append(0, np.cumsum(counts))


def shingle_sets(texts: pa.Array, length: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for a, b in slices(texts):
        found, bounds = shingle_hashes(Words(texts.slice(a, b - a)), length)
        for i in range(b - a):
            own = np.sort(found[bounds[i] : bounds[i + 1]])
            yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit id of a set of shingles."""
    value = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


class MinHash:
    """`size` minima of a set under fixed bijections of 32-bit numbers."""

    def __init__(self, size: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.times = rng.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, size, dtype=np.uint32)

    def permuted(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        out = self.times[:, None] * low + self.plus[:, None]
        return out ^ (out >> np.uint32(15))

    def signature(self, shingles: np.ndarray, block: int = 2048) -> np.ndarray:
        parts = [self.permuted(shingles[i : i + block]).min(axis=1) for i in range(0, len(shingles), block)]
        return parts[0] if len(parts) == 1 else np.minimum.reduce(parts)
