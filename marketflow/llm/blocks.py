"""Numpy views of Arrow text columns: words, hashes of byte ranges, runs.

A word is a maximal run of bytes outside space and 0x09 to 0x0D.  Texts are UTF-8, where those
bytes never occur inside another character, so splitting bytes equals splitting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATORS = b" \t\n\x0b\x0c\r"
IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True

#: An odd multiplier, its inverse modulo 2**64, and a second pair for sequences of words.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below n at least; kept between calls."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length()) if n > 1 else 1 << 16
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        have = _powers[base] = (up, down)
    return have


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and where each text starts, one more for the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes; a longer document is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def text_slices(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, end, bytes, offsets) for ranges of about ``size`` bytes."""
    data, offsets = text_bytes(column)
    for a, b in slices(offsets, size):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside``, cut at document offsets."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(inside))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each document's first word (and the end)."""
    starts, ends = runs(~IS_SEPARATOR[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(symbols: np.ndarray, base: int) -> np.ndarray:
    """Sums of ``symbol * base**i``: with them the hash of any range is one subtraction."""
    up, _ = powers(base, len(symbols) + 1)
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up[: len(symbols)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Mixed polynomial hashes of the ranges [start, end)."""
    _, down = powers(base, len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = prefix_sums(data.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    return range_hashes(sums, starts, ends, BYTE_BASE)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive symbols (those that cross documents included)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(hashes, WORD_BASE)
    at = np.arange(count)
    return range_hashes(sums, at, at + n, WORD_BASE)


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """True for each of ``size`` places inside some [start, start + width)."""
    marks = np.zeros(size + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + width, size), -1)
    return np.cumsum(marks[:-1]) > 0
