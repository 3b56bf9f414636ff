"""CRC-32 of many byte strings at once."""

from __future__ import annotations

from collections.abc import Collection

import numpy as np

POLYNOMIAL = 0xEDB88320
ALL_ONES = np.uint32(0xFFFFFFFF)
# Longer strings are cut into rows of this length, whose registers are put together.
ROW = 1024


def _table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, crc >> 1 ^ np.uint32(POLYNOMIAL), crc >> 1)
    return crc


TABLE = _table()


def advance(crc: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Registers after the bytes of a matrix with a row for each of them, column by column."""
    for column in columns.T:
        crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc


def _bits() -> np.ndarray:
    return np.uint32(1) << np.arange(32, dtype=np.uint32)


# What a row of zero bytes makes of each bit of a register.
ROW_SHIFT = advance(_bits(), np.zeros((32, ROW), np.uint8))


def _long(word: bytes) -> int:
    """CRC of one long string: its rows advance together from zero, then each is shifted past the rows after it."""
    data = np.frombuffer(word, np.uint8)
    whole = len(data) // ROW
    parts = advance(np.zeros(whole, np.uint32), data[: whole * ROW].reshape(whole, ROW))
    crc = ALL_ONES
    for part in parts:
        crc = np.bitwise_xor.reduce(ROW_SHIFT[(crc & _bits()) > 0], initial=np.uint32(0)) ^ part
    return int(advance(np.array([crc], np.uint32), data[None, whole * ROW:])[0] ^ ALL_ONES)


def crc32_of(words: Collection[bytes]) -> dict[bytes, int]:
    """CRC-32 of distinct strings: those of one length are rows of a matrix and advance together."""
    by_length: dict[int, list[bytes]] = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    out: dict[bytes, int] = {}
    for length, same in by_length.items():
        if length > 2 * ROW:
            out.update((word, _long(word)) for word in same)
            continue
        matrix = np.frombuffer(b"".join(same), np.uint8).reshape(len(same), length)
        crc = advance(np.full(len(same), ALL_ONES), matrix) ^ ALL_ONES
        out.update(zip(same, crc.tolist()))
    return out
