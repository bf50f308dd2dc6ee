"""SimHash fingerprints, linked by Golay-code fuzzy hashing.

Linked fingerprints differ in at most four of 64 bits.  The fingerprint is cut into segments of 23,
23 and 18 bits.  Three errors or more in two of them would be six, so at least two segments hold at
most two errors each, and there both fingerprints share a Golay key.  Every pair of segments gives
composite keys of 24 bits, the product of the two segments' keys; fingerprints that meet under a
composite key are compared bit by bit.  No link is lost.

Only distinct fingerprints are hashed.  Within a key no pairs leave the task: links that hold are
reduced to one link per fingerprint and block before they are shuffled again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm import golay
from marketflow.llm.blocks import IS_SEPARATOR, text_slices
from marketflow.llm.components import connected_components, local_roots
from marketflow.llm.shipping import arrow_map, fresh_name
from marketflow.session import stored

SEED, SHINGLE, BITS, MOST_DIFFERENT = 42, 4, 64, 4
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Rows of a key that are compared with one another at a time.
BLOCK = 4096
#: Rows of the sorted keys that are looked at together.
BATCH = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPREAD = bytes(32 if IS_SEPARATOR[i] else int(LOWER[i]) for i in range(256))


def fingerprint_of(text: bytes) -> int:
    """The fingerprint of one text; 0 for a text without words."""
    words = text.translate(SPREAD).split()
    if not words:
        return 0
    line = b" ".join(words)
    n = len(words) - SHINGLE + 1
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[: n - 1]]).tolist()
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    raw = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    for a in range(0, len(raw), 4096):
        counts += np.unpackbits(raw[a : a + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return int(sum(1 << int(b) for b in bits))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer, one row per row of ``docs``.

    Null, empty and wordless texts have fingerprint zero.  Other columns are ignored; no shuffle.
    """

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[int] = []
            for a, b, data, at in text_slices(batch.column(1)):
                raw = data.tobytes()
                out.extend(fingerprint_of(raw[at[i] : at[i + 1]]) for i in range(b - a))
            values = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "fp"])

    return arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), compute, "doc_id long, fp long"
    )


def fuzzy_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, composite key) of 64-bit fingerprints."""
    u = values.view(np.uint64)
    parts = []
    for begin, width in SEGMENTS:
        segment = (u >> np.uint64(begin)) & np.uint64((1 << width) - 1)
        row, key = golay.keys(segment, width)
        parts.append((np.searchsorted(row, np.arange(len(u) + 1)), key.astype(np.int64)))
    rows, out = [], []
    for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        (at_i, key_i), (at_j, key_j) = parts[i], parts[j]
        n_i, n_j = np.diff(at_i), np.diff(at_j)
        size = n_i * n_j
        row = np.repeat(np.arange(len(u)), size)
        k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        first, second = k // n_j[row], k % n_j[row]
        rows.append(row)
        out.append(pair << 24 | key_i[at_i[row] + first] << 12 | key_j[at_j[row] + second])
    return np.concatenate(rows), np.concatenate(out)


def _pairs_in_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal keys whose fingerprints differ in few bits; keys are sorted.

    Rows are compared at growing distance in the sorted order, as far as any key reaches.
    """
    a_out, b_out = [], []
    left = np.arange(len(key))
    for d in range(1, len(key)):
        left = left[left + d < len(key)]
        left = left[key[left] == key[left + d]]
        if not len(left):
            break
        near = np.bitwise_count(fp[left] ^ fp[left + d]) <= MOST_DIFFERENT
        if near.any():
            a_out.append(left[near])
            b_out.append(left[near] + d)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a_out), np.concatenate(b_out)) if a_out else (none, none)


def _forest(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """At most one link per distinct fingerprint that connects what the links a-b connect."""
    value, place = np.unique(fp, return_inverse=True)
    root = local_roots(len(value), place[a], place[b])
    moved = np.flatnonzero(root != np.arange(len(value)))
    return pa.RecordBatch.from_arrays(
        [pa.array(value[moved].view(np.int64)), pa.array(value[root[moved]].view(np.int64))], ["a", "b"]
    )


def _link_large(fp: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links among the many fingerprints of one key, block against block in bounded memory."""
    for i in range(0, len(fp), BLOCK):
        left = fp[i : i + BLOCK]
        for j in range(i, len(fp), BLOCK):
            right = fp[j : j + BLOCK]
            a_all, b_all = [], []
            for s in range(0, len(left), 256):
                near = np.bitwise_count(left[s : s + 256, None] ^ right[None, :]) <= MOST_DIFFERENT
                a, b = np.nonzero(near)
                a_all.append(a + s)
                b_all.append(b + len(left))
            out = _forest(np.concatenate([left, right]), np.concatenate(a_all), np.concatenate(b_all))
            if out.num_rows:
                yield out


def link_fingerprints(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints (fp, each once) within four bits of one another."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for a in range(0, len(values), 4096):
                part = values[a : a + 4096]
                row, key = fuzzy_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(part[row])], ["key", "fp"])

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.zeros(0, np.int32), np.zeros(0, np.uint64)

        def linked(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.diff(key)) + 1
            begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
            large = ends - begins > BLOCK
            small = np.repeat(~large, ends - begins)
            k, f = key[small], fp[small]
            a, b = _pairs_in_runs(k, f)
            if len(a):
                yield _forest(f, a, b)
            for x, y in zip(begins[large], ends[large]):
                yield from _link_large(fp[x:y])

        for batch in batches:
            rest_key = np.concatenate([rest_key, batch.column(0).to_numpy()])
            rest_fp = np.concatenate([rest_fp, batch.column(1).to_numpy().view(np.uint64)])
            if len(rest_key) < BATCH:
                continue
            last = int(np.searchsorted(rest_key, rest_key[-1]))  # the last key may go on in the next batch
            if last:
                yield from linked(rest_key[:last], rest_fp[:last])
                rest_key, rest_fp = rest_key[last:], rest_fp[last:]
        if len(rest_key):
            yield from linked(rest_key, rest_fp)

    keyed = arrow_map(distinct.select("fp"), spread, "key int, fp long")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return arrow_map(dealt, link, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most four differing bits.
    Texts without words have fingerprint zero and are linked like others.  A null doc_id is kept and
    never is a component's id unless it stands alone.  Repeated rows get equal answers; an empty table
    gives none; other columns are ignored.
    """
    marked = stored(fingerprints(docs), "fingerprints")
    groups = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = stored(groups, "fingerprint-groups")
    roots = connected_components(link_fingerprints(groups))
    member = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's smallest; repeated rows of it become one.

    Rows without a doc_id cannot be told apart by it and are kept.  All columns stay as they are.
    """
    found = stored(near_duplicates(docs), "near-duplicates")
    kept_id = fresh_name(docs, "kept_id")
    kept = found.where(F.col("doc_id") == F.col("component_id")).groupBy(F.col("doc_id").alias(kept_id)).count()
    repeated = not kept.where("count > 1").limit(1).isEmpty()
    kept = kept.select(kept_id).hint("shuffle_hash")
    named = docs.join(kept, docs["doc_id"].cast("long") == kept[kept_id], "left_semi")
    if repeated:  # otherwise dropping them would sort all texts for nothing
        named = named.dropDuplicates(["doc_id"])
    return named.unionByName(docs.where(F.col("doc_id").isNull()))
