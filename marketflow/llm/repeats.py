"""Repeated windows across all texts: the frame that both substring operators share.

A window is W consecutive symbols (words or bytes) of one text.  Its anchor is the smallest hash among
its runs of K symbols, so equal windows have equal anchors wherever they stand.  Consecutive windows
of a text with the same anchor form a segment, and every window is in exactly one segment.

1. Every text reports its anchors.  An anchor is live if it stands in two places or more.  Within an
   Arrow batch that is settled at once; otherwise one report per batch and anchor goes to the anchor's
   bucket, so a common anchor is reported once per batch and not once per text.  The reports count, too,
   in how many places an anchor stands: one with more than a small share of a bucket's work is hot.
2. The texts with live anchors send the symbols of those segments to the anchor's bucket; the same
   segment of several texts of a batch goes once.  All windows that could be equal meet there.  For hot
   anchors they send digests of single windows instead, one per distinct window and batch with its
   earliest place and whether it was seen twice; these are dealt by the whole window, so that an anchor
   that most texts share is spread over all buckets.
3. Each bucket decides which of its windows are repeats (this is where the operators differ), and
   the texts get these back as runs of window starts.

The reports are written to the shared folder, since they decide what is hot and how many buckets keep
the segments of each within a bound.  They name a text by a hash of its id and content (tid), which
another reading gives again.  After that texts are shuffled once, by that hash; the exchange serves both
readings, and a number (rid) tells rows of one hash apart.  What travels is packed by batch and bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.blocks import (
    BYTE_BASE,
    WORD_BASE,
    mix,
    prefix_sums,
    range_hashes,
    slices,
    text_slices,
    word_hashes,
    words,
)
from marketflow.llm.shipping import arrow_map, ship_package
from marketflow.session import stored

NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Buckets for each shuffle partition, at least.
BUCKETS_PER_PARTITION = 4
#: Bytes of segments that a bucket is to hold on average (a place sends about three windows' bytes).
BUCKET_BYTES = 64 << 20
#: An anchor is hot if it stands in more places than this share of a bucket's average, and in so many at least.
HOT_SHARE, HOT_LEAST = 1 / 8, 256

RUNS = "tid long, rid long, start long, n long"


@dataclass(frozen=True)
class Windows:
    """W symbols per window, K per anchor; symbols are words or bytes."""

    width: int
    anchor: int
    of_words: bool

    @property
    def grams(self) -> int:
        return self.width - self.anchor + 1


@dataclass
class Symbols:
    """The symbols of a block of texts: byte bounds, first symbol of each text, hash sums."""

    starts: np.ndarray | None
    ends: np.ndarray | None
    first: np.ndarray
    sums: np.ndarray
    base: int

    @classmethod
    def read(cls, w: Windows, data: np.ndarray, offsets: np.ndarray) -> Symbols:
        if w.of_words:
            starts, ends, first = words(data, offsets)
            return cls(starts, ends, first, prefix_sums(word_hashes(data, starts, ends), WORD_BASE), WORD_BASE)
        return cls(None, None, offsets, prefix_sums(data.astype(np.uint64) + np.uint64(1), BYTE_BASE), BYTE_BASE)

    def hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the n symbols from each place on."""
        return range_hashes(self.sums, at, at + n, self.base)

    def bytes_of(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte bounds of the symbols [begin, end), none empty."""
        if self.starts is None:
            return begin, end
        return self.starts[begin], self.ends[end - 1]


def sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every n neighbours."""
    out, have = values, 1
    while have * 2 <= n:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = n - have
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def window_anchors(w: Windows, s: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows, their anchors, and every gram's hash (NEVER where it would cross texts)."""
    n = len(s.sums) - 1
    sizes = np.diff(s.first)
    if n < w.width or not (sizes >= w.width).any():
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.arange(n - w.anchor + 1)
    grams = np.minimum(s.hashes(at, w.anchor), NEVER - np.uint64(1))
    least = sliding(grams, w.grams, np.minimum)
    whole = np.zeros(n + 1, np.int32)
    long = sizes >= w.width
    np.add.at(whole, s.first[:-1][long], 1)
    np.add.at(whole, s.first[1:][long] - w.width + 1, -1)
    places = np.flatnonzero(np.cumsum(whole[: len(least)]) > 0)
    return places, least[places], grams


def anchor_places(w: Windows, places: np.ndarray, anchors: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Where the anchors of windows stand: grams that equal the anchor of a window around them."""
    most = np.zeros(len(grams) + w.grams - 1, np.uint64)
    most[places + w.grams - 1] = anchors
    # the anchor of a window is at most any of its grams, so a gram is one if the largest anchor around is it
    around = sliding(most, w.grams, np.maximum)
    return np.flatnonzero((around == grams) & (around > 0))


def segments(s: Symbols, places: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor) of the runs of windows with one anchor."""
    if not len(places):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    doc = np.searchsorted(s.first, places, "right") - 1
    cut = np.flatnonzero((np.diff(places) != 1) | (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])) + 1
    begin = np.concatenate([[0], cut])
    return doc[begin], places[begin], np.diff(np.concatenate([begin, [len(places)]])), anchors[begin]


def pack(*arrays: np.ndarray) -> bytes:
    parts = [np.ascontiguousarray(a) for a in arrays]
    head = np.array([len(parts), *[p.nbytes for p in parts]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(p.tobytes() for p in parts))


def unpack(blob: bytes, kinds: tuple) -> list[np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(plain, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(plain, np.int64, n, 8), 8 * (n + 1), []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(plain, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def dealt(bucket: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows) of the buckets that have rows; rows keep their order."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(ends)):
        yield int(b), order[ends[b] : ends[b + 1]]


# --- 1: anchors ---------------------------------------------------------------------------------

ASK, TELL, SURE = 0, 1, 2
REPORT = ("<u8", "<i8", "u1", "<u4")


def _report(w: Windows, n_buckets: int) -> Callable:
    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tids = batch.column(0).to_numpy()
            values, docs = [], []
            for a, _, data, at in text_slices(batch.column(1)):
                s = Symbols.read(w, data, at)
                places, anchors, grams = window_anchors(w, s)
                if not len(places):
                    continue
                stand = anchor_places(w, places, anchors, grams)
                values.append(grams[stand])
                docs.append(np.searchsorted(s.first, stand, "right") - 1 + a)
            if not values:
                continue
            value, doc = np.concatenate(values), np.concatenate(docs)
            order = np.argsort(value, kind="stable")
            value, doc = value[order], doc[order]
            new = np.concatenate([[True], value[1:] != value[:-1]])
            group = np.cumsum(new) - 1
            places_of = np.bincount(group)[group]
            sure = places_of > 1
            # of a value seen twice here: one message to its bucket, and every text is told by way of others
            once = np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])
            told, direct = new & sure, sure & once
            v = np.concatenate([value[~sure], value[told], value[direct]])
            d = np.concatenate([doc[~sure], doc[told], doc[direct]])
            n = np.concatenate([places_of[~sure], places_of[told], places_of[direct]]).astype(np.uint32)
            kind = np.repeat([ASK, TELL, SURE], [int((~sure).sum()), int(told.sum()), int(direct.sum())]).astype(np.uint8)
            spread = np.where(kind == SURE, mix(tids[d].view(np.uint64)), mix(v))
            bucket = (spread % np.uint64(n_buckets)).astype(np.int64)
            numbers, blobs = [], []
            for b, rows in dealt(bucket, n_buckets):
                numbers.append(b)
                blobs.append(pack(v[rows], tids[d[rows]], kind[rows], n[rows]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"]
            )

    return report


def _live(least: int) -> Callable[[pa.Table], pa.Table]:
    """(tid, anchor, null) of the reports of one bucket that name a live anchor; (null, anchor, places) of
    anchors with ``least`` places or more; (null, null, places) of all live anchors together."""

    def live(group: pa.Table) -> pa.Table:
        parts = [unpack(b, REPORT) for b in group.column("blob").to_pylist()]
        value, tid, kind, n = (np.concatenate(p) for p in zip(*parts))
        asked = np.flatnonzero(kind != SURE)
        order = asked[np.argsort(value[asked], kind="stable")]
        ranked = value[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        sizes = np.diff(first, append=len(ranked))
        places = np.add.reduceat(n[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        answered = order[np.repeat(places > 1, sizes)]
        answered = answered[kind[answered] == ASK]
        out = np.concatenate([answered, np.flatnonzero(kind == SURE)])
        many = places >= least
        none = [None] * (int(many.sum()) + 1)
        anchors = [*ranked[first[many]].view(np.int64).tolist(), None]
        counts = [*places[many].tolist(), int(places[places > 1].sum())]
        return pa.table(
            {
                "tid": pa.chunked_array([pa.array(tid[out]), pa.array(none, pa.int64())]),
                "anchor": pa.chunked_array([pa.array(value[out].view(np.int64)), pa.array(anchors, pa.int64())]),
                "places": pa.chunked_array([pa.nulls(len(out), pa.int64()), pa.array(counts, pa.int64())]),
            }
        )

    return live


# --- 2: segments --------------------------------------------------------------------------------

#: Segments: tid, rid, order, first window, windows, bytes, seen twice in its batch, text.  Runs settled in the
#: batch: tid, rid, first window, windows.  Single windows of hot anchors: tid, rid, order, place, two hashes,
#: seen twice.
SEGMENT = (
    "<i8", "<i8", "<i8", "<i8", "<i4", "<i4", "u1", "u1", "<i8", "<i8", "<i8", "<i8",
    "<i8", "<i8", "<i8", "<i8", "<u8", "<u8", "u1",
)
#: The second hash of single windows.
OTHER_BASE = 0xA24BAED4963EE407


def _listed(lists: pa.Array, a: int, b: int, salt: np.ndarray) -> np.ndarray:
    """The values of rows a to b of a list column, each mixed with its row's salt."""
    lists = lists.slice(a, b - a)
    ends = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].view(np.uint64)
    return mix(values + np.repeat(salt, np.diff(ends)))


def _window_digests(w: Windows, s: Symbols, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows that begin at each place."""
    symbols = data.astype(np.uint64) + np.uint64(1) if s.starts is None else word_hashes(data, s.starts, s.ends)
    other = prefix_sums(mix(symbols), OTHER_BASE)
    return s.hashes(at, w.width), range_hashes(other, at, at + w.width, OTHER_BASE)


def as_runs(tid: np.ndarray, rid: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(tid, rid, first, n) of the maximal runs of distinct (rid, place)."""
    order = np.lexsort((place, rid))
    tid, rid, place = tid[order], rid[order], place[order]
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    return tid[first], rid[first], place[first], np.diff(first, append=len(rid))


def equal_windows(one: np.ndarray, two: np.ndarray, keys: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered by window and then by ``keys`` (the last weighs most), and which of them begin a window."""
    order = np.lexsort((*keys, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    return order, new


def _send(w: Windows, n_buckets: int, spare_first: bool) -> Callable:
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, orders, tids = (batch.column(i).to_numpy() for i in (0, 1, 6))
            seen: dict[bytes, int] = {}
            rows: list[tuple] = []  # row of the batch, first window, windows, anchor of each distinct segment
            texts: list[bytes] = []
            twice: list[bool] = []
            settled: list[tuple] = []
            single: list[tuple] = []  # arrays of the windows of hot anchors
            for a, b, data, at in text_slices(batch.column(2)):
                s = Symbols.read(w, data, at)
                places, anchors, _ = window_anchors(w, s)
                doc, begin, count, anchor = segments(s, places, anchors)
                if not len(doc):
                    continue
                salt = mix(np.arange(1, b - a + 1, dtype=np.uint64))
                keys = mix(anchor + salt[doc])
                hot = np.isin(keys, _listed(batch.column(4), a, b, salt))
                if hot.any():
                    n = count[hot]
                    own = np.repeat(np.flatnonzero(hot), n)
                    start = begin[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                    single.append((a + doc[own], start - s.first[doc[own]], *_window_digests(w, s, data, start)))
                hit = np.isin(keys, _listed(batch.column(3), a, b, salt)) & ~hot
                doc, begin, count, anchor = doc[hit], begin[hit], count[hit], anchor[hit]
                if not len(doc):
                    continue
                left, right = s.bytes_of(begin, begin + count + w.width - 1)
                raw = data.tobytes()
                local = begin - s.first[doc]
                for d, x, n, v, i, j in zip(
                    (a + doc).tolist(), local.tolist(), count.tolist(), anchor.tolist(), left.tolist(), right.tolist()
                ):
                    text = raw[i:j]
                    have = seen.setdefault(text, len(rows))
                    if have == len(rows):
                        rows.append((d, x, n, v))
                        texts.append(text)
                        twice.append(False)
                        continue
                    d2, x2, _, _ = rows[have]
                    if spare_first and (orders[d], rids[d], x) < (orders[d2], rids[d2], x2):
                        # the earlier of the two stays to be compared; all windows of the later one repeat
                        rows[have] = (d, x, n, v)
                        settled.append((d2, x2, n))
                    else:
                        twice[have] = True
                        settled.append((d, x, n))
            if not rows and not single:
                continue
            done = np.array(settled, np.int64).reshape(-1, 3)
            d1, place1, one, two = _singles(single)
            order, new = equal_windows(one, two, (place1, rids[d1], orders[d1]))
            twice1 = (np.diff(np.flatnonzero(new), append=len(order)) > 1).astype(np.uint8)
            runs = as_runs(d1[order[~new]], d1[order[~new]], place1[order[~new]])
            done = np.concatenate([done, np.stack(runs[1:], axis=1)])
            d1, place1, one, two = (c[order[new]] for c in (d1, place1, one, two))
            table = np.array([r[:3] for r in rows], np.int64).reshape(-1, 3)
            value = np.array([r[3] for r in rows], np.uint64)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            flags = np.array(twice, np.uint8)
            places_of = [
                dict(dealt((mix(v) % np.uint64(n_buckets)).astype(np.int64), n_buckets)) if len(v) else {}
                for v in (value, tids[done[:, 0]].view(np.uint64), one)
            ]
            none = np.zeros(0, np.int64)
            numbers, blobs = [], []
            for k in sorted(set().union(*places_of)):
                r, e, h = (p.get(k, none) for p in places_of)
                text = np.frombuffer(b"".join([texts[i] for i in r.tolist()]), np.uint8)
                row, gone, d = table[r, 0], done[e, 0], d1[h]
                numbers.append(k)
                blobs.append(
                    pack(
                        tids[row], rids[row], orders[row], table[r, 1], table[r, 2].astype(np.int32),
                        sizes[r].astype(np.int32), flags[r], text, tids[gone], rids[gone], done[e, 1], done[e, 2],
                        tids[d], rids[d], orders[d], place1[h], one[h], two[h], twice1[h],
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"]
            )

    return send


def _singles(parts: list[tuple]) -> list[np.ndarray]:
    """Row of the batch, place and two hashes of single windows."""
    if not parts:
        return [np.zeros(0, k) for k in (np.int64, np.int64, np.uint64, np.uint64)]
    return [np.concatenate(c) for c in zip(*parts)]


@dataclass
class Segments:
    """The segments of one bucket, in order of (order, rid, first window)."""

    rid: np.ndarray
    start: np.ndarray
    count: np.ndarray
    twice: np.ndarray
    shard: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def _solve(w: Windows, decide: Callable[[Segments], np.ndarray], spare_first: bool) -> Callable:
    """``decide`` gives one flag for each window, segment after segment."""

    def solve(group: pa.Table) -> pa.Table:
        parts = [unpack(b, SEGMENT) for b in group.column("blob").to_pylist()]
        shard = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        columns = [np.concatenate(p) for p in zip(*parts)]
        tid, rid, order, start, count, size, twice, data = columns[:8]
        out = [columns[8:12], _settled_singles(*columns[12:], spare_first)]
        del parts, columns
        if len(rid):
            rank = np.lexsort((start, rid, order))
            at = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
            rank, twice, later = _distinct(data, at, rank, twice > 0)
            # all windows of a segment that an earlier one equals repeat; that one stays to be compared
            out.append((tid[later], rid[later], start[later], count[later]))
            sizes = size[rank].astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            moved = data[np.repeat(at[rank] - offsets[:-1], sizes) + np.arange(offsets[-1])]
            count = count[rank].astype(np.int64)
            found = Segments(rid[rank], start[rank], count, twice[rank], shard[rank], moved, offsets)
            flags = decide(found)
            begin = np.concatenate([[0], np.cumsum(count)])
            seg = np.repeat(np.arange(len(count)), count)
            place = start[rank][seg] + np.arange(len(seg)) - begin[seg]
            hit = np.flatnonzero(flags)
            if len(hit):
                cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(seg[hit]) != 0)) + 1
                first = np.concatenate([[0], cut])
                n = np.diff(np.concatenate([first, [len(hit)]]))
                own = rank[seg[hit[first]]]
                out.append((tid[own], rid[own], place[hit[first]], n))
        names = ("tid", "rid", "start", "n")
        return pa.table({k: pa.array(np.concatenate(c).astype(np.int64)) for k, c in zip(names, zip(*out))})

    return solve


def _settled_singles(tid, rid, order, place, one, two, twice, spare_first: bool) -> tuple[np.ndarray, ...]:
    """The repeats among the single windows of one bucket, as runs."""
    ranked, new = equal_windows(one, two, (place, rid, order))
    if spare_first:
        again = ranked[~new]
    else:
        group = np.cumsum(new) - 1
        again = ranked[np.bincount(group, weights=1 + twice[ranked])[group] > 1] if len(ranked) else ranked
    return as_runs(tid[again], rid[again], place[again])


def _distinct(data: np.ndarray, at: np.ndarray, rank: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of equal segments in the order of ``rank``, which of them were seen twice, and the others.

    Batches send equal segments of their own once; here those of different batches meet.  They are told
    apart by size and hash, and compared byte by byte with the first one.
    """
    digest = np.empty(len(at) - 1, np.uint64)
    for a, b in slices(at, 1 << 22):  # hash sums take many times the bytes that they are of
        sums = prefix_sums(data[at[a] : at[b]].astype(np.uint64) + np.uint64(1), BYTE_BASE)
        digest[a:b] = range_hashes(sums, at[a:b] - at[a], at[a + 1 : b + 1] - at[a], BYTE_BASE)
    digest = digest[rank]
    order = np.argsort(digest, kind="stable")
    lead = order[np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(digest[order]) != 0]), np.arange(len(order)), 0))]
    first, other = rank[lead], rank[order]
    size = np.diff(at)
    same = (first != other) & (size[first] == size[other])
    check = np.flatnonzero(same)
    n = size[other[check]]
    ends = np.cumsum(n)
    step = np.arange(ends[-1]) if len(ends) else np.zeros(0, np.int64)
    own = np.repeat(at[other[check]] - ends + n, n) + step
    its = np.repeat(at[first[check]] - ends + n, n) + step
    if len(check):
        same[check] = np.logical_and.reduceat(data[own] == data[its], ends - n)
    twice = twice.copy()
    twice[first[same]] = True
    gone = np.zeros(len(at) - 1, bool)
    gone[other[same]] = True
    return rank[~gone[rank]], twice, np.flatnonzero(gone)


# --- all together -------------------------------------------------------------------------------


def numbered(docs: DataFrame) -> DataFrame:
    """(rid, ord, text, doc_id, tid): rows with a number of their own and a hash of id and text."""
    text, doc_id = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id").cast("long")
    return docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.coalesce(doc_id, F.lit(-(1 << 63))).alias("ord"),
        text.alias("text"),
        doc_id.alias("doc_id"),
        F.xxhash64(doc_id, text).alias("tid"),
    )


def _places(live: DataFrame) -> int:
    """Places of all live anchors."""
    return live.where("tid is null and anchor is null").agg(F.sum("places")).first()[0] or 0


def repeated_windows(
    docs: DataFrame, w: Windows, decide: Callable[[Segments], np.ndarray], spare_first: bool
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as by :func:`numbered`, shuffled, and their repeats (rid, start, n): runs of window
    starts (symbol numbers within the text).

    ``spare_first``: a window is a repeat if an equal one starts earlier, in order of (ord, rid, place);
    otherwise if an equal one starts anywhere else.
    """
    ship_package(docs.sparkSession)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = numbered(docs)
    reports = arrow_map(rows.select("tid", "text"), _report(w, BUCKETS_PER_PARTITION * partitions), "bucket int, blob binary")
    live = stored(reports.groupBy("bucket").applyInArrow(_live(HOT_LEAST), "tid long, anchor long, places long"), "anchors")
    places = _places(live)
    per_place = 3 * w.width * (8 if w.of_words else 1)
    n_buckets = max(BUCKETS_PER_PARTITION * partitions, places * per_place // BUCKET_BYTES)
    bound = max(HOT_LEAST, int(HOT_SHARE * places / n_buckets))
    hot = live.where((F.col("places") > bound) & F.col("anchor").isNotNull()).select("anchor", F.lit(True).alias("hot"))
    told = live.where("tid is not null").select("tid", "anchor")
    # each hot anchor has more than an eighth of a bucket's places: there are eight for each bucket at most
    told = told.join(F.broadcast(hot), "anchor", "left")
    lists = told.groupBy("tid").agg(
        F.expr("collect_list(anchor) FILTER (WHERE hot IS NULL)").alias("anchors"),
        F.expr("collect_list(anchor) FILTER (WHERE hot)").alias("hots"),
    )
    # both readings take all columns, so that one exchange serves them
    rows = rows.repartition(partitions, "tid").select("rid", "ord", "text", "doc_id", "tid")
    chosen = rows.join(lists.hint("shuffle_hash"), "tid").select("rid", "ord", "text", "anchors", "hots", "doc_id", "tid")
    sent = arrow_map(chosen, _send(w, n_buckets, spare_first), "bucket int, blob binary")
    return rows, sent.groupBy("bucket").applyInArrow(_solve(w, decide, spare_first), RUNS)


def with_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """(doc_id, text, runs, rid, ord, tid): every row with the runs of its hash (null: none)."""
    lists = runs.groupBy("tid").agg(F.collect_list(F.struct("rid", "start", "n")).alias("runs"))
    found = rows.join(lists.hint("shuffle_hash"), "tid", "left")
    return found.select("doc_id", "text", "runs", "rid", "ord", "tid")


def runs_of(rid: int, found: pa.Scalar) -> list[tuple[int, int]]:
    """(first window, windows) of a row, from the runs of its hash."""
    return [(x["start"], x["n"]) for x in found.as_py() or () if x["rid"] == rid]


def spans(rows: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """(doc_id, start, end): the maximal stretches of symbols that the runs' windows cover."""

    def unite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, starts, ends = [], [], []
            for doc_id, rid, found in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(2)):
                reach = -1
                for begin, end in sorted((x, x + n - 1 + width) for x, n in runs_of(rid, found)):
                    if begin > reach:
                        docs.append(doc_id)
                        starts.append(begin)
                        ends.append(end)
                    ends[-1] = reach = max(reach, end)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (docs, starts, ends)], ["doc_id", "start", "end"]
            )

    return arrow_map(with_runs(rows, runs), unite, "doc_id long, start long, end long")


def covered_symbols(runs: list[tuple[int, int]], width: int, size: int) -> np.ndarray:
    """True for each symbol inside a window of the runs (first window, windows)."""
    marks = np.zeros(size + 1, np.int32)
    for start, n in runs:
        marks[start] += 1
        marks[min(size, start + n - 1 + width)] -= 1
    return np.cumsum(marks[:-1]) > 0
