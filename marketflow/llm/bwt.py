"""Merging Burrows-Wheeler transforms of shards by interleave refinement.

The strings are windows of ``depth`` symbols, each symbol a block of bytes.  A shard's transform is, for
every depth t, the column of symbols that stand before its suffixes of t symbols, in the order of those
suffixes, and the order in which these symbols deal the suffixes to depth t + 1.

Two shards are merged without sorting anything again.  An interleave says for every suffix of each shard
which rank it has among both.  It starts with one shard after the other (all suffixes of no symbols are
equal).  Each round reads the shards' next columns as they were dealt, that is in ascending order of
(symbol, rank): a suffix's new rank is its own number among those of its shard plus the number of the
other shard's that stand before it.  The round also derives how many symbols neighbours have in common:
none if their symbols differ, otherwise one more than the least common prefix between their tails.
A merged transform has the form of a shard's, so that any number of shards is merged in pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Transform:
    """By depth: ``columns`` of symbols and the places ``deal`` that each suffix of the next depth comes
    from.  At full depth: the ``order`` of windows and the symbols ``common`` with the one before."""

    columns: list[np.ndarray]
    deal: list[np.ndarray]
    order: np.ndarray
    common: np.ndarray


def transform(symbols: list[np.ndarray], windows: np.ndarray) -> Transform:
    """The transform of windows given as their symbols, ``symbols[j][i]`` the j-th of ``windows[i]``."""
    order = np.arange(len(windows))
    columns, deal = [], []
    for column in reversed(symbols):
        columns.append(column[order])
        deal.append(np.argsort(columns[-1], kind="stable"))
        order = order[deal[-1]]
    same, common = np.arange(len(order)) > 0, np.zeros(len(order), np.int8)
    for column in symbols:
        same[1:] &= column[order[1:]] == column[order[:-1]]
        common += same
    return Transform(columns, deal, windows[order], common)


def _joint(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for two ascending lists of symbols that keep their order and are equal for equal symbols."""

    def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(x), bool)
        new[1:] = x[1:] != x[:-1]
        return x[new], np.cumsum(new) - 1

    (x, at_x), (y, at_y) = distinct(a), distinct(b)
    return (np.arange(len(x)) + np.searchsorted(y, x))[at_x], (np.arange(len(y)) + np.searchsorted(x, y))[at_y]


def _least_between(common: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
    """The least of ``common`` after place low up to place high, of values up to ``depth``."""
    out = np.zeros(len(low), np.int8)
    for h in range(1, depth + 1):
        group = np.cumsum(common < h)
        out += group[low] == group[high]
    return out


def merge_two(a: Transform, b: Transform) -> Transform:
    n_a, n = len(a.order), len(a.order) + len(b.order)
    rank_a, rank_b = np.arange(n_a), np.arange(n_a, n)
    common = np.zeros(n, np.int8)
    columns, deal = [], []
    for t in range(len(a.columns)):
        column = np.empty(n, np.uint64)
        column[rank_a], column[rank_b] = a.columns[t], b.columns[t]
        symbol_a, symbol_b = _joint(a.columns[t][a.deal[t]], b.columns[t][b.deal[t]])
        from_a, from_b = rank_a[a.deal[t]], rank_b[b.deal[t]]
        key_a, key_b = symbol_a * n + from_a, symbol_b * n + from_b  # both ascend
        rank_a = np.arange(n_a) + np.searchsorted(key_b, key_a)
        rank_b = np.arange(n - n_a) + np.searchsorted(key_a, key_b)
        source = np.empty(n, np.int64)
        source[rank_a], source[rank_b] = from_a, from_b
        columns.append(column)
        deal.append(source)
        same = column[source[1:]] == column[source[:-1]]
        longer = np.zeros(n, np.int8)
        longer[1:][same] = 1 + _least_between(common, source[:-1][same], source[1:][same], t)
        common = longer
    order = np.empty(n, np.int64)
    order[rank_a], order[rank_b] = a.order, b.order
    return Transform(columns, deal, order, common)


def merge(shards: list[Transform]) -> Transform:
    """All shards in one, by rounds of pairs."""
    while len(shards) > 1:
        pairs = [merge_two(a, b) for a, b in zip(shards[::2], shards[1::2])]
        shards = pairs + shards[len(pairs) * 2 :]
    return shards[0]
