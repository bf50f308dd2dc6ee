"""CRC-32 of many words, and of words joined by single spaces, in numpy.

CRC-32 is linear: the checksum of a joined text is that of its first part, moved on by as many zero
bytes as the second part has, XOR that of the second part.  Moving on is a table lookup per byte.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

#: Words of up to this many bytes go through the tables side by side; longer ones singly.
SHORT = 64
#: Moves of fewer bytes have a table each.
MOVES = 256


@functools.cache
def _step() -> np.ndarray:
    """What a zero byte makes of each low byte (reflected polynomial 0xEDB88320, fixed)."""
    v = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        v = np.where(v & 1, (v >> np.uint32(1)) ^ np.uint32(0xEDB88320), v >> np.uint32(1))
    return v


def _zero_byte(v: np.ndarray) -> np.ndarray:
    return _step()[v & np.uint32(255)] ^ (v >> np.uint32(8))


@functools.cache
def _moves() -> np.ndarray:
    """(256, 4, 256): what L zero bytes make of each value of each of the four bytes."""
    out = np.empty((MOVES, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))
    for k in range(1, MOVES):
        out[k] = _zero_byte(out[k - 1])
    return out


@functools.cache
def _doubled(power: int) -> np.ndarray:
    """(4, 256): the table of 2**power zero bytes."""
    if power < 8:
        return _moves()[1 << power]
    half = _doubled(power - 1)
    return _apply(half, half)


def _apply(table: np.ndarray, v: np.ndarray) -> np.ndarray:
    out = table[0][v & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ table[k][(v >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def moved(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The checksums ``crc`` moved on by ``size`` zero bytes each."""
    table = _moves()
    low = np.minimum(size, MOVES - 1)
    out = table[low, 0, crc & np.uint32(255)]
    for k in range(1, 4):
        out ^= table[low, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    far = np.flatnonzero(size >= MOVES)
    if len(far):
        v, rest = crc[far], size[far]
        for power in range(int(rest.max()).bit_length()):
            has = np.flatnonzero((rest >> power) & 1)
            v[has] = _apply(_doubled(power), v[has])
        out[far] = v
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte ranges [start, end)."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint32)
    long = np.flatnonzero(size > SHORT)
    for i in long.tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    short = np.flatnonzero(size <= SHORT)
    short = short[np.argsort(-size[short], kind="stable")]
    begin, step = starts[short], _step()
    more = len(short) - np.cumsum(np.bincount(size[short], minlength=SHORT + 1))  # words longer than j bytes
    v = np.full(len(short), 0xFFFFFFFF, np.uint32)
    for j in range(SHORT):
        n = int(more[j])
        if n == 0:
            break
        v[:n] = step[(v[:n] ^ data[begin[:n] + j]) & np.uint32(255)] ^ (v[:n] >> np.uint32(8))
    out[short] = ~v
    return out


def run_crcs(crc: np.ndarray, size: np.ndarray, longest: int) -> list[np.ndarray]:
    """For n = 1 to ``longest`` the checksums of every n consecutive words joined by one space.

    ``crc`` and ``size`` are those of the words; entry i of list n - 1 begins at word i.
    """
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    spaced = moved(space, size) ^ crc
    out = [crc]
    for n in range(1, longest):
        if len(crc) <= n:
            out.append(np.zeros(0, np.uint32))
        else:
            out.append(moved(out[-1][: len(crc) - n], size[n:] + 1) ^ spaced[n:])
    return out
