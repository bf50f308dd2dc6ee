"""Vector compression by product codes in integers, with adaptive bounds in place of full searches.

Components become integers floor(1024 * x); a vector is cut into four equal parts, and each part is
replaced by the index of the nearest of 256 codebook entries.  Codebooks start as the parts of the 256
smallest vec_ids and take four rounds of assignment and rounded-down means, then a last assignment.

An assignment compares a part with all entries only once.  Every part keeps, in the table that the
rounds hand on, its entry with an upper bound of the distance, the next b entries with lower bounds in
ascending order, and one outer bound for all others.  When entries move, bounds give way by the
distances moved (by the largest for the outer bound), and are put in order again by a running minimum
from the outside.  A part whose upper bound is below its first lower bound keeps its entry unseen.
Otherwise its own distance is computed, then those of the entries whose bound it still reaches; only a
part that reaches the outer bound is searched in full.  b follows what the last round needed.

Distances are exact integers and ties go to the lower index; bounds are single floats, rounded away
from the claim, and decide only strict differences, so that the codes are those of full searches.
Entry sums change only by the parts that changed their entry: tasks add these changes up and Spark
adds the tasks' rows.  The driver holds the codebooks (4 x 256 entries) and nothing of the vectors.

Rows with a null vector or with null, NaN or infinite components are dropped, and so are vectors whose
length is not the table's most frequent one (of ties the larger) that four divides.  Null vec_ids are
kept and come last in the codebooks' start; repeated rows are coded each; with fewer than 256 vectors
there are as many entries.  An empty table gives an empty result.  Integers beyond +-2**27 are held
there, so that squared distances stay within 64 bits; a sum of errors beyond them is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.shipping import arrow_map
from marketflow.llm.vectors import binaries, is_finite, matrix, to_binaries, with_group_total
from marketflow.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMIT = 1 << 27
#: Width of the lower bounds: at the start, and the least and most that it adapts to.
FIRST_WIDTH, LEAST_WIDTH, MOST_WIDTH = 12, 3, 48
#: The width covers this share of the parts that were compared, and grows where more parts than that share were searched in full.
COVERED, FULL_SHARE = 0.99, 0.05
ROWS = 2048
FAR = np.iinfo(np.int64).max


def to_integers(vectors: np.ndarray) -> np.ndarray:
    """(row, component) of floats as (row, part, component) of integers."""
    whole = np.clip(np.floor(SCALE * vectors), -LIMIT, LIMIT).astype(np.int64)
    return whole.reshape(len(whole), PARTS, -1)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x, np.float64).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x, np.float64).astype(np.float32), np.float32(-np.inf))


def all_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances (row, entry) of integers (row, component) and (entry, component)."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < 1 << 52:  # every step is an integer that a double holds
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in book], axis=1)


def nearest(x: np.ndarray, book: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the ids of its nearest entry and the next ``width``, and the distance bounds.

    Returns ids (row, 1 + width), bounds (row, 2 + width): upper, lower ones, outer; and the squared
    distance.  Where there are fewer entries the row's own id and infinity fill up.
    """
    d, n = all_distances(x, book), len(book)
    take = min(width + 2, n)
    if int(d.max(initial=0)) < FAR // ENTRIES:  # the index as the key's last byte settles ties
        keys = d * ENTRIES + np.arange(n)
        order = np.sort(np.partition(keys, take - 1, axis=1)[:, :take], axis=1)
        found, dist = order % ENTRIES, order // ENTRIES
    else:
        found = np.argsort(d, axis=1, kind="stable")[:, :take]
        dist = np.take_along_axis(d, found, 1)
    ids = np.repeat(found[:, :1], 1 + width, axis=1).astype(np.uint8)
    bounds = np.full((len(x), 2 + width), np.inf, np.float32)
    bounds[:, 0] = _up(np.sqrt(dist[:, 0]))
    known = min(take, width + 1)
    ids[:, :known] = found[:, :known]
    bounds[:, 1:take] = _down(np.sqrt(dist[:, 1:take]))
    return ids, bounds, dist[:, 0]


def resized(ids: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Another number of lower bounds: the first one dropped becomes the outer bound, or that one fills up."""
    old = ids.shape[1] - 1
    if width <= old:
        return ids[:, : width + 1].copy(), bounds[:, : width + 2].copy()
    return (
        np.concatenate([ids, np.repeat(ids[:, :1], width - old, axis=1)], axis=1),
        np.concatenate([bounds, np.repeat(bounds[:, -1:], width - old, axis=1)], axis=1),
    )


def in_order(bounds: np.ndarray) -> None:
    """Lower bounds never above one that stands further out."""
    bounds[:, 1:] = np.minimum.accumulate(bounds[:, :0:-1], axis=1)[:, ::-1]


def reassign(x: np.ndarray, book: np.ndarray, ids: np.ndarray, bounds: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Brings ids and bounds (changed in place) up to moved entries; returns how deep each row went:
    -1 not looked at, 0 its own distance, k the first k of its list, width + 1 all entries."""
    width = ids.shape[1] - 1
    wide = bounds.astype(np.float64)
    wide[:, 0] += shift[ids[:, 0]]
    wide[:, 1:-1] -= shift[ids[:, 1:]]
    wide[:, -1] -= shift.max()
    bounds[:, 0] = _up(wide[:, 0])
    bounds[:, 1:] = _down(wide[:, 1:])
    in_order(bounds)
    depth = np.full(len(x), -1)
    row = np.flatnonzero(bounds[:, 0] >= bounds[:, 1])
    own = ((x[row] - book[ids[row, 0]]) ** 2).sum(1)
    bounds[row, 0] = _up(np.sqrt(own))
    depth[row] = (bounds[row, 1:] <= bounds[row, :1]).sum(1)  # the outer bound counts as width + 1
    some = np.flatnonzero((depth[row] > 0) & (depth[row] <= width))
    if len(some):
        own, some = own[some], row[some]
        most = int(depth[some].max())
        dist = np.full((len(some), most + 1), FAR)
        dist[:, 0] = own
        for k in range(1, most + 1):
            on = np.flatnonzero(depth[some] >= k)
            dist[on, k] = ((x[some[on]] - book[ids[some[on], k]]) ** 2).sum(1)
        near = ids[some, : most + 1]
        order = np.lexsort((near, dist), axis=1)  # places not computed are last, in any order
        dist, sorted_ids = np.take_along_axis(dist, order, 1), np.take_along_axis(near, order, 1)
        seen = dist < FAR
        ids[some, : most + 1] = np.where(seen, sorted_ids, near)
        bounds[some, 0] = _up(np.sqrt(dist[:, 0]))
        bounds[some, 1 : most + 1] = np.where(seen[:, 1:], _down(np.sqrt(dist[:, 1:])), bounds[some, 1 : most + 1])
    full = np.flatnonzero(depth > width)
    if len(full):
        ids[full], bounds[full], _ = nearest(x[full], book, width)
    in_order(bounds)
    return depth


def _add(change: np.ndarray, entry: np.ndarray, x: np.ndarray, sign: int) -> None:
    """Adds counts and component sums of the rows ``x`` to their entries."""
    if len(entry):
        order = np.argsort(entry, kind="stable")
        first = np.flatnonzero(np.diff(entry[order], prepend=-1))
        here = entry[order[first]]
        change[here, 1:] += sign * np.add.reduceat(x[order], first, axis=0)
        change[here, 0] += sign * np.diff(first, append=len(entry))


def _changes(change: np.ndarray, depths: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """A task's last rows: its changes of entries, and (part -1) how many parts went how deep."""
    part, entry = np.nonzero(change.any(axis=2))
    deep = np.flatnonzero(depths)
    values = [*change[part, entry].tolist(), *depths[deep, None].tolist()]
    own = {
        "part": pa.array([*part.tolist(), *[-1] * len(deep)], pa.int32()),
        "entry": pa.array([*entry.tolist(), *deep.tolist()], pa.int32()),
        "change": pa.array(values, pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays(
        [own.get(f.name, pa.nulls(len(values), f.type)) for f in schema], schema=schema
    )


def _state(batch: pa.RecordBatch, x, ids, bounds) -> pa.RecordBatch:
    n = len(x)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0), batch.column(1), to_binaries(x.astype("<i4")), to_binaries(ids), to_binaries(bounds),
            pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())),
        ],
        ["vec_id", "label", "ints", "ids", "bounds", "part", "entry", "change"],
    )


def _first(books: np.ndarray, width: int) -> Callable:
    """(vec_id, label, embedding) to the first state, every part searched in full."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        schema = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                x = to_integers(matrix(piece.column(2)))
                found = [nearest(x[:, p], books[p], width) for p in range(PARTS)]
                for p in range(PARTS):
                    _add(change[p], found[p][0][:, 0].astype(np.int64), x[:, p], 1)
                out = _state(piece, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1))
                schema = out.schema
                yield out
        if schema is not None:
            yield _changes(change, np.zeros(1, np.int64), schema)

    return run


def _loaded(piece: pa.RecordBatch, books: np.ndarray, shift: np.ndarray, width: int):
    """Integers of a piece of the state, and ids, bounds and depths after :func:`reassign`."""
    n = piece.num_rows
    x = binaries(piece.column(2), "<i4").astype(np.int64).reshape(n, PARTS, -1)
    ids = binaries(piece.column(3), np.uint8).reshape(n, PARTS, -1)
    bounds = binaries(piece.column(4), np.float32).reshape(n, PARTS, -1)
    out = []
    for p in range(PARTS):
        i, b = resized(ids[:, p], bounds[:, p], width)
        depth = reassign(x[:, p], books[p], i, b, shift[p])
        out.append((i, b, depth))
    return x, ids[:, :, 0].astype(np.int64), out


def _next(books: np.ndarray, shift: np.ndarray, width: int) -> Callable:
    """A state to the next one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        depths, schema = np.zeros(width + 3, np.int64), None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                x, before, found = _loaded(piece, books, shift, width)
                for p, (ids, _, depth) in enumerate(found):
                    now = ids[:, 0].astype(np.int64)
                    moved = np.flatnonzero(now != before[:, p])
                    _add(change[p], before[moved, p], x[moved, p], -1)
                    _add(change[p], now[moved], x[moved, p], 1)
                    depths += np.bincount(depth + 1, minlength=width + 3)
                out = _state(piece, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1))
                schema = out.schema
                yield out
        if schema is not None:
            yield _changes(change, depths, schema)

    return run


def _last(books: np.ndarray, shift: np.ndarray, width: int) -> Callable:
    """The last state to (vec_id, label, code, error)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                x, _, found = _loaded(piece, books, shift, width)
                code = np.stack([ids[:, 0] for ids, _, _ in found], axis=1)
                error = sum(((x[:, p] - books[p][code[:, p]]) ** 2).sum(1) for p in range(PARTS))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), to_binaries(code), pa.array(error)],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def next_width(depths: dict[int, int], width: int, entries: int) -> int:
    """How many lower bounds to keep, from how many parts went how deep (-1: not looked at)."""
    most = min(MOST_WIDTH, max(1, entries - 2))
    if depths.get(width + 1, 0) > FULL_SHARE * max(1, sum(depths.values())):
        return min(2 * width, most)
    within = {k: n for k, n in depths.items() if 0 < k <= width}
    need, seen = 0, 0
    for k in sorted(within):
        if seen < COVERED * sum(within.values()):
            need, seen = k, seen + within[k]
    return min(max(need, LEAST_WIDTH), width, most)


def new_books(books: np.ndarray, sums: dict[tuple[int, int], list[int]]) -> np.ndarray:
    """Rounded-down means; entries without parts stay."""
    out = books.copy()
    for (part, entry), (count, *total) in sums.items():
        if count:
            out[part, entry] = [int(t) // int(count) for t in total]
    return out


def _totals(state: DataFrame, sums: dict) -> dict[int, int]:
    """Adds the changes of a state to ``sums``; returns the depths.  At most 4 x 256 x (1 + part) values come."""
    rows = state.where("part is not null").select("part", "entry", F.posexplode("change").alias("at", "value"))
    depths: dict[int, int] = {}
    for part, entry, at, value in rows.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect():
        if part < 0:
            depths[entry - 1] = int(value)
        else:
            sums[part, entry][at] += int(value)
    return depths


def compress(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row of ``vectors`` (vec_id,
    embedding, label); other columns are ignored."""
    rows = vectors.select("vec_id", "label", "embedding").where(is_finite("embedding"))
    fits = rows.where((F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0))
    usual = fits.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    kept = fits.where(F.size("embedding") == F.lit(usual["d"] if usual else 0))
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    label = rows.schema["label"].dataType.simpleString()
    if not start:
        return kept.select(
            F.col("vec_id").cast("long"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"),
        )
    books = to_integers(np.array([r[0] for r in start], np.float64)).transpose(1, 0, 2).copy()
    entries, size = books.shape[1], books.shape[2]
    sums = {(p, e): [0] * (1 + size) for p in range(PARTS) for e in range(entries)}
    width = min(FIRST_WIDTH, max(1, entries - 2))
    schema = f"vec_id long, label {label}, ints binary, ids binary, bounds binary, part int, entry int, change array<long>"
    typed = kept.withColumn("vec_id", F.col("vec_id").cast("long"))
    state = stored(arrow_map(typed, _first(books, width), schema), "codes")
    for k in range(ROUNDS):
        depths = _totals(state, sums)
        if k:
            width = next_width(depths, width, entries)
        moved = new_books(books, sums)
        gone = np.sqrt(((moved - books).astype(np.float64) ** 2).sum(2))
        books, shift = moved, np.nextafter(gone * (1 + 1e-12), np.inf)
        inputs = state.where("part is null").select("vec_id", "label", "ints", "ids", "bounds")
        if k < ROUNDS - 1:
            state = stored(arrow_map(inputs, _next(books, shift, width), schema), "codes")
        else:
            last = arrow_map(inputs, _last(books, shift, width), f"vec_id long, label {label}, code binary, error long")
    last = stored(last, "codes")
    digest = hashlib.sha256(",".join(str(v) for v in books.reshape(-1).tolist()).encode()).hexdigest()
    totals = last.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    return with_group_total(last, "label", totals).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _oracle() -> str:
    """The same by full searches; one set of common table expressions per round."""
    out = ["""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label, len(embedding) // 4 AS d,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT rid, p, list_slice(v, p * d + 1, p * d + d) AS x, d FROM kept, range(4) AS t(p)
), first AS (
  SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 256
), book0 AS (
  SELECT p, e, x AS c FROM parts JOIN first USING (rid)
)"""]
    for k in range(ROUNDS + 1):
        out.append(f"""
, far{k} AS (
  SELECT rid, p, e, list_sum(list_transform(range(1, d + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS q
  FROM parts JOIN book{k} USING (p)
), near{k} AS (
  SELECT rid, p, arg_min(e, q * 256 + e) AS e, min(q) AS q FROM far{k} GROUP BY rid, p
)""")
        if k < ROUNDS:
            out.append(f"""
, each{k} AS (
  SELECT p, e, i, sum(x[i]) AS s, count(*) AS n
  FROM (SELECT p, e, x, unnest(range(1, d + 1)) AS i FROM near{k} JOIN parts USING (rid, p)) GROUP BY p, e, i
), mean{k} AS (
  SELECT p, e, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY i) AS c FROM each{k} GROUP BY p, e
), book{k + 1} AS (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} AS b LEFT JOIN mean{k} AS m USING (p, e)
)""")
    out.append(f"""
, coded AS (
  SELECT rid, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(q)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (rid)""")
    return "".join(out)


ORACLE = _oracle()
