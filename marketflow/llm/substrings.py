"""Repeated passages of words, by suffix trees over prefix groups.

Suffixes are the texts from each word on, of which the first W words count.  They reach a bucket
by their windows' anchors, prefixes of anchors too frequent for one bucket having been lengthened to
the whole window before anything is loaded (:mod:`marketflow.llm.repeats`).  In a bucket suffixes are
split by prefixes of variable length: of five words first, and of five more wherever a group still has
more suffixes than a subtree may hold.  A group of one suffix has no branching above it and is dropped.
Each remaining group is a subtree: its suffixes in order, with the words that neighbours have in common.
Where these are W or more lies an internal node of depth W; the leaves below it are a repeat, and the
earliest of them stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketflow.llm import repeats as R
from marketflow.llm.blocks import SEPARATORS, word_hashes, words
from marketflow.llm.shipping import arrow_map

WORDS = R.Windows(width=20, anchor=5, of_words=True)
#: Words by which a prefix grows at a time.
STEP = 5
#: Suffixes of a subtree, at most: what is in memory besides the bucket's words.
GROUP = 1 << 18


def prefix_groups(sums: np.ndarray, suffixes: np.ndarray, width: int, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """Groups of suffix numbers, with the length of the prefix that each of their suffixes shares with
    another one; neighbouring groups come together as long as they have up to ``most`` suffixes.

    A prefix grows only in groups of more than ``most``; one of full length is given as it is.  Suffixes
    keep their order.  ``sums`` are the hash sums of the words.
    """
    todo = [(np.arange(len(suffixes)), 0)]
    while todo:
        some, depth = todo.pop()
        n = min(STEP, width - depth)
        key = R.range_hashes(sums, suffixes[some] + depth, suffixes[some] + depth + n, R.WORD_BASE)
        order = np.argsort(key, kind="stable")
        some, key, depth = some[order], key[order], depth + n
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(first, append=len(key))
        small = (size > 1) & (size <= most)
        for x, m in zip(first[size > most].tolist(), size[size > most].tolist()):
            if depth == width:
                yield some[x : x + m], depth
            else:
                todo.append((some[x : x + m], depth))
        rest, ends = some[np.repeat(small, size)], np.cumsum(size[small])
        begin = 0
        while begin < len(rest):
            end = int(ends[np.searchsorted(ends, begin + most, "right") - 1])
            yield rest[begin:end], depth
            begin = end


def subtree(symbols: np.ndarray, suffixes: np.ndarray, some: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes ``some`` in ascending order of their words, equal ones as given, and how many of the
    first ``width`` words each has in common with the one before."""
    at = suffixes[some]
    columns = [symbols[at + k] for k in range(width)]
    keys = [(columns[k].astype(np.uint64) << np.uint64(32)) | columns[k + 1].astype(np.uint64) for k in range(0, width - 1, 2)]
    keys += columns[len(keys) * 2 :]
    order = np.lexsort(keys[::-1])
    same, common = np.arange(len(order)) > 0, np.zeros(len(order), np.int64)
    for column in columns:
        ranked = column[order]
        same[1:] &= ranked[1:] == ranked[:-1]
        common += same
    return some[order], common


def deep_nodes(symbols: np.ndarray, sums: np.ndarray, suffixes: np.ndarray, width: int, most: int = GROUP) -> tuple[np.ndarray, np.ndarray]:
    """(suffix number, node) of suffixes below internal nodes of depth ``width``, those of a node in the
    order they were given in."""
    out, node, nodes = [], [], 0
    for some, _ in prefix_groups(sums, suffixes, width, most):
        ranked, common = subtree(symbols, suffixes, some, width)
        number = np.cumsum(common < width) - 1
        many = (np.bincount(number) > 1)[number]
        if many.any():
            out.append(ranked[many])
            node.append(number[many] + nodes)
            nodes += int(number[-1]) + 1
    none = np.zeros(0, np.int64)
    return (np.concatenate(out), np.concatenate(node)) if out else (none, none)


def later_leaves(found: R.Segments) -> np.ndarray:
    """Flags of the windows of a bucket that another, earlier one equals."""
    starts, ends, first = words(found.data, found.offsets)
    hashes = word_hashes(found.data, starts, ends)
    value, symbols = np.unique(hashes, return_inverse=True)
    sums = R.prefix_sums(hashes, R.WORD_BASE)
    seg = np.repeat(np.arange(len(found.count)), found.count)
    begin = np.cumsum(found.count) - found.count
    suffixes = first[:-1][seg] + np.arange(len(seg)) - begin[seg]
    suffix, node = deep_nodes(symbols, sums, suffixes, WORDS.width)
    flags = np.zeros(len(seg), bool)
    if len(suffix):
        later = np.concatenate([[False], node[1:] == node[:-1]])
        flags[suffix[later]] = True
    return flags


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end): maximal stretches of words in windows that start earlier too; end exclusive.

    Earlier means a smaller doc_id (null first), or an earlier place in the same text; rows of one
    doc_id are ordered as read.
    """
    rows, runs = R.repeated_windows(docs, WORDS, later_leaves, spare_first=True)
    return R.spans(rows, runs, WORDS.width)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): every row of ``docs`` without its repeated passages.

    A word goes if a window of 20 words around it starts earlier too.  Null, empty and short texts
    lose nothing; repeated rows keep their text once; an empty table gives no rows; other columns are
    ignored.  Kept words are joined by single spaces.
    """
    return _cut(docs, digest=False)


def repeat_report(docs: DataFrame) -> DataFrame:
    """As :func:`without_repeats`, with the SHA-256 of the kept text instead of it."""
    return _cut(docs, digest=True)


def _cut(docs: DataFrame, digest: bool) -> DataFrame:
    rows, runs = R.repeated_windows(docs, WORDS, later_leaves, spare_first=True)
    last = "kept_sha256" if digest else "kept_text"
    # bytes.split() without arguments splits at exactly these
    assert sorted(SEPARATORS) == [9, 10, 11, 12, 13, 32]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found, rid in zip(batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                every = text.as_py().encode().split()
                left = every
                if found.is_valid and len(found):
                    spans = R.runs_of(rid, found)
                    left = list(compress(every, (~R.covered_symbols(spans, WORDS.width, len(every))).tolist()))
                line = b" ".join(left)
                n_words.append(len(every))
                n_removed.append(len(every) - len(left))
                kept.append(hashlib.sha256(line).hexdigest() if digest else line.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", last],
            )

    return arrow_map(R.with_runs(rows, runs), cut, f"doc_id long, n_words long, n_removed long, {last} string")


#: :func:`repeat_report` by brute force: every window of every document as a text.
ORACLE = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS nth FROM places
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM ranked, (SELECT unnest(range(20)) AS k) WHERE nth > 1
), each AS (
  SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS line FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
