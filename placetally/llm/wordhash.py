"""Hashes of all words of many texts at once."""

from __future__ import annotations

import numpy as np

from placetally.llm.common import WHITE_SPACE, mixed

_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE_SPACE)] = True
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def powers(step: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every white-space separated word, text after text, and the number of words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    letter = ~_SPACE[data]
    starts = np.flatnonzero(letter & ~np.r_[False, letter[:-1]])
    text_ends = np.cumsum([len(x) + 1 for x in texts])
    counts = np.diff(np.searchsorted(starts, np.r_[0, text_ends]))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(first[-1] + lengths[-1], dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
    values = _BYTE[data[letter]] * powers(_STEP, int(lengths.max()))[within]
    return mixed(np.add.reduceat(values, first) ^ lengths.astype(np.uint64)), counts


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(size, np.uint64)
    for j, p in enumerate(powers(np.uint64(0xD6E8FEB86659FD93), n)):
        total += words[j:j + size] * p
    return mixed(total)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out
