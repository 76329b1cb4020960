"""Statistics of a text that tell junk from prose, for whole Arrow columns at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.llm.words import Words, mix, release, slices, window_hashes, window_starts

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5

#: What the rules themselves use, then what only the trees see.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "digit_share",
    "words_a_line", "short_line_share", "distinct_share", "echo_share", "longest_word",
)

_UPPER, _MARK, _DIGIT, _SYMBOL, _TAIL = (np.zeros(256, dtype=bool) for _ in range(5))
_UPPER[65:91] = True
_MARK[list(b"!?;:\"'()[]{}=_~^@\\/`")] = True
_DIGIT[48:58] = True
_SYMBOL[list(SYMBOLS)] = True
_TAIL[128:192] = True


def _sums(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marks each text has."""
    where = np.flatnonzero(marks)
    return np.diff(np.searchsorted(where, bounds))


def _lines(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each text: lines with a word, those of them with less than three words, and lines equal to an earlier one."""
    out = np.zeros((len(bounds) - 1, 3), dtype=np.int64)
    whole = data.tobytes()
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        lines = [x for x in whole[a:b].split(b"\n") if x and not x.isspace()]
        out[i] = len(lines), sum(len(x.split(None, 2)) < 3 for x in lines), len(lines) - len(set(lines))
    return out


def repeated_words(hashes: np.ndarray, first: np.ndarray, length: int = REPEAT_WINDOW) -> np.ndarray:
    """How many words of each text lie in a window that the text has twice or more."""
    starts, counts = window_starts(first, length)
    out = np.zeros(len(first) - 1, dtype=np.int64)
    if not len(starts):
        return out
    doc = np.repeat(np.arange(len(counts)), counts)
    keys = window_hashes(hashes, starts, length) ^ mix(doc.astype(np.uint64))
    ordered = np.sort(keys)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return out
    at = np.searchsorted(again, keys)
    at[at == len(again)] = 0
    hit = starts[again[at] == keys]
    cover = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.subtract.at(cover, hit + length, 1)
    covered = np.append(0, np.cumsum(np.cumsum(cover[:-1]) > 0))
    return covered[first[1:]] - covered[first[:-1]]


def _distinct(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(counts)), counts)
    keys = np.sort(((hashes >> np.uint64(32)) | (doc.astype(np.uint64) << np.uint64(32))))
    new = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    return np.bincount((new >> np.uint64(32)).astype(np.int64), minlength=len(counts))


def _of_slice(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts)
    data, bounds, n = words.data, words.bounds, words.counts()
    hashes = words.hashes()
    word_bytes = np.append(0, np.cumsum(words.ends - words.starts))
    in_words = word_bytes[words.first[1:]] - word_bytes[words.first[:-1]]
    chars = in_words - _sums(_TAIL[data], bounds)
    symbols, repeats, lines = _sums(_SYMBOL[data], bounds), repeated_words(hashes, words.first), _lines(data, bounds)
    echo = np.append(0, np.cumsum(np.append(False, hashes[1:] == hashes[:-1]))) if len(hashes) else np.zeros(1, dtype=np.int64)
    longest = np.zeros(len(n))
    if len(hashes):
        full = n > 0
        longest[full] = np.maximum.reduceat(words.ends - words.starts, words.first[:-1][full])
    some, some_chars, some_lines = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(lines[:, 0], 1)
    counts = np.stack([n, chars, symbols, lines[:, 2], repeats], axis=1)
    features = np.stack(
        [
            np.log1p(n), chars / some, symbols / some, lines[:, 2] / some_lines, repeats / some, _sums(_UPPER[data], bounds) / some_chars,
            _sums(_MARK[data], bounds) / some, _sums(_DIGIT[data], bounds) / some_chars, n / some_lines, lines[:, 1] / some_lines,
            _distinct(hashes, n) / some, (echo[words.first[1:]] - echo[words.first[:-1]]) / some, np.log1p(longest),
        ],
        axis=1,
    )
    return counts, features


def of_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS (whole numbers) and FEATURES (floats), a row for each text. Null counts as empty."""
    parts = [_of_slice(texts.slice(a, b - a)) for a, b in slices(texts)]
    if not parts:
        return np.zeros((0, len(COUNTS)), dtype=np.int64), np.zeros((0, len(FEATURES)))
    release()
    return np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts])
