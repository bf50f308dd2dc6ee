"""The binary [23, 12, 7] Golay code as a fuzzy hash of 23-bit words.

The code is perfect: every word lies within 3 bits of exactly one code word.  A word's keys are the
code words nearest to it and to its neighbours at one bit.  Two words that differ in at most two bits
have a word within one bit of both, so they share a key.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, PARITY = 23, 11
#: The generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (a fixed value of the code).
GENERATOR = 0b101011100011


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of single bits, and the error pattern of each remainder."""
    remainders = []
    r = 1
    for _ in range(LENGTH):
        remainders.append(r)
        r <<= 1
        if r >> PARITY:
            r ^= GENERATOR
    errors = np.zeros(1 << PARITY, np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            s = 0
            for b in bits:
                s ^= remainders[b]
            errors[s] = sum(1 << b for b in bits)
    # remainders of every byte value at each of three byte positions
    by_byte = np.zeros((3, 256), np.uint32)
    for place in range(3):
        for value in range(256):
            s = 0
            for b in range(8):
                if value >> b & 1 and 8 * place + b < LENGTH:
                    s ^= remainders[8 * place + b]
            by_byte[place, value] = s
    return by_byte, errors


def decode(words: np.ndarray) -> np.ndarray:
    """The 12 information bits of the code word nearest to each word."""
    by_byte, errors = _tables()
    w = words.astype(np.uint32)
    s = by_byte[0][w & 255] ^ by_byte[1][(w >> 8) & 255] ^ by_byte[2][(w >> 16) & 127]
    return (w ^ errors[s]) >> PARITY


def keys(words: np.ndarray, used_bits: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs, each once, for words whose upper bits beyond ``used_bits`` are zero."""
    w = words.astype(np.uint32)
    near = np.stack([w] + [w ^ np.uint32(1 << b) for b in range(used_bits)], axis=1)
    codes = np.sort(decode(near), axis=1)
    fresh = np.ones(codes.shape, bool)
    fresh[:, 1:] = codes[:, 1:] != codes[:, :-1]
    row, _ = np.nonzero(fresh)
    return row, codes[fresh]
