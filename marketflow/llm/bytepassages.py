"""Repeated byte strings, from merged Burrows-Wheeler transforms of the shards of each bucket.

All windows of 400 bytes that could be equal meet in one bucket (:mod:`marketflow.llm.repeats`), as the
segments that each Arrow batch sent.  Segments of consecutive batches are a shard: their windows, as four
symbols of 100 bytes, are transformed by themselves, and the shards' transforms are merged by interleave
refinement (:mod:`marketflow.llm.bwt`).  Neighbours with all four symbols in common are the repeats.  A
symbol is named by a 64-bit hash of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketflow.llm import bwt
from marketflow.llm import repeats as R
from marketflow.llm.blocks import BYTE_BASE
from marketflow.llm.shipping import arrow_map

BYTES = R.Windows(width=400, anchor=32, of_words=False)
SYMBOL = 100
DEPTH = BYTES.width // SYMBOL
#: Windows of a shard, about.
SHARD = 1 << 18


def repeated_anywhere(found: R.Segments) -> np.ndarray:
    """Flags of the windows of a bucket that equal another one."""
    sums = R.prefix_sums(found.data.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    n = int(found.count.sum())
    by_batch = np.argsort(found.shard, kind="stable")
    cut = np.cumsum(found.count[by_batch]) // SHARD
    begin = np.cumsum(found.count) - found.count
    seg_of = np.repeat(np.arange(len(found.count)), found.count)
    shards = []
    for mine in np.split(by_batch, np.flatnonzero(np.diff(cut)) + 1):
        count = found.count[mine]
        seg = np.repeat(mine, count)
        step = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
        at = found.offsets[:-1][seg] + step
        symbols = [R.range_hashes(sums, at + k, at + k + SYMBOL, BYTE_BASE) for k in range(0, BYTES.width, SYMBOL)]
        shards.append(bwt.transform(symbols, begin[seg] + step))
    merged = bwt.merge(shards)
    interval = np.cumsum(merged.common < DEPTH) - 1
    weight = 1 + found.twice[seg_of[merged.order]]
    flags = np.zeros(n, bool)
    flags[merged.order[np.bincount(interval, weights=weight)[interval] > 1]] = True
    return flags


def repeated_strings(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end): maximal stretches of bytes in 400-byte strings that occur elsewhere; end exclusive."""
    rows, runs = R.repeated_windows(docs, BYTES, repeated_anywhere, spare_first=False)
    return R.spans(rows, runs, BYTES.width)


def without_repeated_strings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every row of ``docs`` without its repeated strings.

    A byte goes if it lies in a string of 400 bytes that also starts anywhere else, in the same text
    or another (repeated rows are others).  Null, empty and short texts lose nothing; an empty table
    gives no rows; other columns are ignored.  ``kept`` is binary, since a cut may split a character.
    """
    return _cut(docs, digest=False)


def string_report(docs: DataFrame) -> DataFrame:
    """As :func:`without_repeated_strings`, with the SHA-256 of the kept bytes instead of them."""
    return _cut(docs, digest=True)


def _cut(docs: DataFrame, digest: bool) -> DataFrame:
    rows, runs = R.repeated_windows(docs, BYTES, repeated_anywhere, spare_first=False)
    last = "kept_sha256" if digest else "kept"

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, found, rid in zip(batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                raw = text.as_py().encode()
                left, spans = raw, 0
                if found.is_valid and len(found):
                    places = R.runs_of(rid, found)
                    gone = R.covered_symbols(places, BYTES.width, len(raw))
                    left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                n_bytes.append(len(raw))
                n_removed.append(len(raw) - len(left))
                n_spans.append(spans)
                kept.append(hashlib.sha256(left).hexdigest() if digest else left)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", last],
            )

    kind = "string" if digest else "binary"
    return arrow_map(
        R.with_runs(rows, runs), cut, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last} {kind}"
    )
