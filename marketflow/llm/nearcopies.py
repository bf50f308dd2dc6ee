"""Near-duplicates by exact similarity: texts whose sets of five-word shingles have Jaccard 0.8 or more.

1. Words are lower-cased in ASCII; a text of fewer than five words is one shingle.  Rows with equal
   shingle sets become one node, whatever their number.
2. Each node gets the SimHash fingerprint of its set.  Fingerprints within four bits of one another are
   linked by Golay keys (:mod:`simhash`); nodes of one fingerprint, and the two of each link, are to meet.
   That finds nearly equal sets only: at 0.8 fingerprints differ in ten bits or so.  For the others each
   node gets 32 band keys of four minimum hashes each; a pair of similarity 0.8 shares no key with
   probability (1 - 0.8**4)**32 = 5e-8.
3. The smallest node of a fingerprint, link or key is its lead.  A node goes with its shingles to each of
   its leads, once however many of these they share, so that all nodes that share one meet there.  The nodes of a lead
   that are too many for one task are dealt to blocks by hash, and every two blocks meet in a task.
4. There one node after the other leads a round: it is compared with the nodes that are not yet of its
   component, exactly where sizes and minimum hashes allow 0.8, the most promising ones first; whole
   components join at the first link.  A task returns one link per node that found another one, never
   pairs, and a group of like texts is settled by its first rounds.
5. The links of all tasks are united to components (:mod:`components`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.blocks import WORD_BASE, mix, prefix_sums, range_hashes, text_slices, word_hashes, words
from marketflow.llm.components import connected_components
from marketflow.llm.shipping import arrow_map, fresh_name
from marketflow.llm.simhash import LOWER, link_fingerprints, majority
from marketflow.session import stored

SHINGLE, BANDS, BAND = 5, 32, 4
HASHES = BANDS * BAND
#: Similarity as a fraction: 5 * common >= 4 * united.
COMMON, UNITED = 5, 4
#: Of 128 minimum hashes, as many must agree for a pair to be counted exactly.
LEAST_AGREEING = 77
#: A lead's nodes are dealt to blocks of about so many nodes, or so many shingles in all (64 MB).
BLOCK, BLOCK_GRAMS = 2048, 1 << 23
#: Groups of up to so many sets do without minimum hashes; sets that are compared with one at a time.
FEW, CHUNK = 16, 32

FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, ascending, and where each document's begin (and the end)."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    hashes = word_hashes(LOWER[data], starts, ends)
    count = np.diff(first)
    size = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    doc = np.repeat(np.arange(n), size)
    begin = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size) + first[:-1][doc]
    end = np.minimum(begin + SHINGLE, first[1:][doc])
    grams = range_hashes(prefix_sums(hashes, WORD_BASE), begin, end, WORD_BASE)
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return grams[new], np.searchsorted(doc[new], np.arange(n + 1))


def node_numbers(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number for each shingle set; that of the empty set is the same for all."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ np.uint64(WORD_BASE)), dtype=np.uint64)])
    return mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


def minimum_hashes(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(document, 128) minimum hashes; documents without shingles have zeros."""
    out = np.zeros((len(at) - 1, HASHES), np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        begins = at[some]
        for k in range(HASHES):
            out[some, k] = np.minimum.reduceat(grams * FACTORS[k], begins)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """(document, 32) keys, each of four minimum hashes and the band's number."""
    key = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(least), 1))
    for k in range(BAND):
        key = mix(key ^ least[:, k::BAND])
    return key.view(np.int64)


def set_fingerprints(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The SimHash fingerprint of each shingle set; that of the empty set is zero."""
    hashes = mix(grams)
    ends = at.tolist()
    return np.array([majority(hashes[a:b]) for a, b in zip(ends, ends[1:])], np.uint64).view(np.int64)


def _mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in text_slices(batch.column(1)):
            grams, at = shingle_sets(data, offsets)
            keys = band_keys(minimum_hashes(grams, at))
            ends = pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[a:b],
                    pa.array(node_numbers(grams, at)),
                    pa.array(np.diff(at)),
                    pa.array(set_fingerprints(grams, at)),
                    pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1))),
                ],
                ["doc_id", "node", "size", "fp", "keys"],
            )


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, grams) of (node, text), where the text is that node's."""
    for batch in batches:
        for a, b, data, offsets in text_slices(batch.column(1)):
            grams, at = shingle_sets(data, offsets)
            node = batch.column(0)[a:b]
            own = np.flatnonzero(node_numbers(grams, at) == node.to_numpy())
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(own)), pa.array([grams[at[i] : at[i + 1]].tobytes() for i in own.tolist()], pa.binary())],
                ["node", "grams"],
            )


def similar_to(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the sets (sorted shingle hashes) are similar enough to ``one``."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    every = np.concatenate(others)
    place = np.minimum(np.searchsorted(one, every), len(one) - 1)
    common = np.add.reduceat(one[place] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
    return COMMON * common >= UNITED * (len(one) + sizes - common)


def group_roots(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The component of each set, as far as links between ``left`` and ``right`` ones make them.

    Sets are numbered by place; where both sides are the same, all pairs count.  No set is empty.
    """
    n = len(sets)
    root = np.arange(n)
    size = np.fromiter(map(len, sets), np.int64, n)
    least = None
    if n > FEW:
        ends = np.concatenate([[0], np.cumsum(size)])
        least = (minimum_hashes(np.concatenate(sets), ends) >> np.uint64(8)).astype(np.uint16)  # the high bits are zeros
    once = left is right
    for k, i in enumerate(left.tolist()):
        others = right[k + 1 :] if once else right
        others = others[root[others] != root[i]]
        fits = COMMON * np.minimum(size[others], size[i]) >= UNITED * np.maximum(size[others], size[i])
        others = others[fits]
        if least is not None and len(others):
            agree = (least[others] == least[i]).sum(axis=1)
            others, agree = others[agree >= LEAST_AGREEING], agree[agree >= LEAST_AGREEING]
            others = others[np.argsort(-agree, kind="stable")]
        while len(others):
            some, others = others[:CHUNK], others[CHUNK:]
            near = some[similar_to(sets[i], [sets[j] for j in some.tolist()])]
            if len(near):
                joined = np.isin(root, np.append(root[near], root[i]))
                root[joined] = root[joined].min()
                others = others[root[others] != root[i]]
    return root


def _link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of (lead, low, high, block, node, grams), sorted by lead, low and high; such a group
    may go on in the next batch."""
    key: tuple | None = None
    blocks: list[int] = []
    nodes: list[int] = []
    sets: list[np.ndarray] = []

    def linked() -> Iterator[pa.RecordBatch]:
        if key is None or len(nodes) < 2:
            return
        node, block = np.array(nodes), np.array(blocks)
        left = np.flatnonzero(block == key[1])
        right = left if key[1] == key[2] else np.flatnonzero(block == key[2])
        root = group_roots(sets, left, right)
        moved = np.flatnonzero(root != np.arange(len(node)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], ["a", "b"])

    for batch in batches:
        lead, low, high, block, node = (batch.column(i).to_pylist() for i in range(5))
        grams = batch.column(5)
        for i in range(batch.num_rows):
            now = (lead[i], low[i], high[i])
            if now != key:
                yield from linked()
                key, blocks, nodes, sets = now, [], [], []
            blocks.append(block[i])
            nodes.append(node[i])
            sets.append(np.frombuffer(grams[i].as_py(), np.uint64))
    yield from linked()


def fingerprint_members(nodes: DataFrame) -> DataFrame:
    """(lead, node, size) of ``nodes`` (node, size, fp): those whose fingerprints are within four bits of
    one another meet under a lead, directly or over others that do.  The empty set meets none."""
    own = F.struct("node", "size")
    prints = nodes.where("size > 0").select("fp", own.alias("own"))
    groups = stored(prints.groupBy("fp").agg(F.min("own").alias("first"), F.count("*").alias("n")), "near-prints")
    one = groups.select(F.col("fp").alias("a"), F.col("first").alias("x"))
    other = groups.select(F.col("fp").alias("b"), F.col("first").alias("y"))
    linked = link_fingerprints(groups).distinct().join(one, "a").join(other, "b").select("x", "y")
    linked = linked.select(F.least("x.node", "y.node").alias("lead"), F.explode(F.array("x", "y")).alias("own"))
    equal = prints.join(groups.where("n > 1"), "fp").select(F.col("first.node").alias("lead"), "own")
    return equal.unionByName(linked).select("lead", "own.node", "own.size")


def similar_links(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes of similar shingle sets.

    ``nodes`` has (node, least, size, fp, keys), ``least`` being the doc_id of a row of that node in
    ``texts`` (doc_id, text).
    """
    keyed = nodes.select("node", "size", F.explode("keys").alias("key"))
    groups = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1")
    member = keyed.join(groups.select("key", "lead"), "key").select("lead", "node", "size")
    member = stored(member.unionByName(fingerprint_members(nodes)).distinct(), "near-members")
    counts = member.groupBy("lead").agg(F.count("*").alias("n"), F.sum("size").alias("grams"))
    share = F.greatest(F.col("n") / F.lit(BLOCK), F.col("grams") / F.lit(BLOCK_GRAMS))
    large = counts.withColumn("blocks", F.ceil(share).cast("long")).where("blocks > 1").select("lead", "blocks")
    member = member.join(large, "lead", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    member = member.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    dealt = member.withColumn("other", F.explode(every)).select(
        "lead", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node"
    )
    wanted = nodes.join(member.select("node").distinct(), "node", "left_semi").select("node", "least")
    found = texts.join(wanted.hint("shuffle_hash"), texts["doc_id"] == wanted["least"]).select("node", "text")
    # a doc_id that stands in several rows gives its node's set several times
    sets = stored(arrow_map(found, _sets, "node long, grams binary").dropDuplicates(["node"]), "near-sets")
    full = dealt.join(sets, "node").select("lead", "low", "high", "block", "node", "grams")
    order = ["lead", "low", "high"]
    return stored(arrow_map(full.repartition(*order).sortWithinPartitions(*order), _link, "a long, b long"), "near-links")


def components_of_similar(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs`` with a doc_id: the smallest doc_id reachable over
    links of similarity 0.8 or more.  Texts without words are near-duplicates of one another.  Repeated
    rows get equal answers; an empty table gives none; other columns are ignored."""
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = stored(arrow_map(texts, _mark, "doc_id long, node long, size long, fp long, keys array<long>"), "near-marks")
    nodes = marked.groupBy("node").agg(
        F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("size", "fp", "keys")]
    )
    nodes = stored(nodes, "near-nodes")
    roots = connected_components(similar_links(nodes, texts))
    member = nodes.select("node", "least").join(roots, "node", "left")
    member = member.select("node", "least", F.coalesce("root", "node").alias("root"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(ids, "root").select("node", "component_id")
    return marked.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's smallest; repeated rows of it become one.

    Rows without a doc_id cannot be told apart by it, link nothing and are kept.  All columns stay.
    """
    found = stored(components_of_similar(docs), "near-components")
    kept_id = fresh_name(docs, "kept_id")
    kept = found.where(F.col("doc_id") == F.col("component_id")).groupBy(F.col("doc_id").alias(kept_id)).count()
    repeated = not kept.where("count > 1").limit(1).isEmpty()
    kept = kept.select(kept_id).hint("shuffle_hash")
    named = docs.join(kept, docs["doc_id"].cast("long") == kept[kept_id], "left_semi")
    if repeated:  # otherwise dropping them would sort all texts for nothing
        named = named.dropDuplicates(["doc_id"])
    return named.unionByName(docs.where(F.col("doc_id").isNull()))
