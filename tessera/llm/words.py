"""Vectorised words, word hashes and rolling window hashes over Arrow batches of texts.

A word is a maximal run of characters other than space and U+0009 to U+000D. All hashes are 64 bits wide,
depend on the bytes alone and are the same in every worker.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are taken in slices of about so many bytes, which bounds a worker's temporary arrays.
SLICE_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_LANE_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Words with more lanes of eight bytes are hashed one at a time.
_LANES = 32


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # other C libraries return memory by themselves
    _trim = None


def release() -> None:
    """Hands freed memory back to the system, so that a worker between batches holds little."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each text begins and ends in them. Null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or bounds[-1] == bounds[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes of text; a longer text is a range of its own."""
    _, bounds = raw_bytes(texts)
    start, n = 0, len(texts)
    while start < n:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, side="right")) - 1)
        end = min(end, n)
        yield start, end
        start = end


class Words:
    """The words of some texts: where each begins and ends in `data`; text i has words first[i] to first[i + 1].

    `separator` marks the bytes between words, `fold` replaces every byte by another first."""

    def __init__(self, texts: pa.Array, separator: np.ndarray = _SEPARATOR, fold: np.ndarray | None = None):
        data, bounds = raw_bytes(texts)
        data = data if fold is None else fold[data]
        self.data, self.bounds = data, bounds
        apart = separator[data]
        before, after = np.ones(len(data), dtype=bool), np.ones(len(data), dtype=bool)
        before[1:], after[:-1] = apart[:-1], apart[1:]
        full = bounds[1:] > bounds[:-1]
        before[bounds[:-1][full]] = True
        after[bounds[1:][full] - 1] = True
        self.starts = np.flatnonzero(before & ~apart)
        self.ends = np.flatnonzero(after & ~apart) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        h = mix(lengths.astype(np.uint64) + _BASE)
        if not len(h):
            return h
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        lanes = np.ndarray(shape=(len(self.data),), dtype="<u8", buffer=padded, strides=(1,))
        active: np.ndarray | slice = slice(None)
        for lane in range(_LANES):
            left = lengths[active] - 8 * lane
            h[active] = mix(h[active] ^ (lanes[self.starts[active] + 8 * lane] & _LANE_MASK[np.minimum(left, 8)]))
            more = np.flatnonzero(left > 8)
            active = more if isinstance(active, slice) else active[more]
            if not len(active):
                return h
        for i in active:
            h[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes())
        return h


def window_starts(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows of `length` items that stay within one text: their first items, and how many each text has."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first[:-1] - (ends - counts), counts), counts


def window_hashes(items: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp: the polynomial hash of each window, as a difference of prefix sums modulo 2**64, then mixed."""
    size = 1 << max(10, int(len(items)).bit_length())
    up, down = _powers(size)
    prefix = np.zeros(len(items) + 1, dtype=np.uint64)
    np.cumsum(items * up[: len(items)], out=prefix[1:])
    return mix((prefix[starts + length] - prefix[starts]) * down[starts])


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: planes that are constant cost next to nothing."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes, count: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = pa.decompress(blob, decompressed_size=count * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(size, count).T).view(dtype).ravel()
