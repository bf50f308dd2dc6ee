"""Near-duplicate vectors by small-world graphs per shard.

Vectors are compared where label and length are equal; pairs of cosine 0.93 or more link.

1. Equal vectors are one node with a count of copies, summed map-side.
2. A label's nodes are dealt by hash to shards of bounded size.  A task builds one shard's graph
   (:mod:`hnsw`).  Near copies within half the linking angle of a graph node do not enter the graph
   but join that node's ball, which has the members' mean as its centre and a radius.
3. Every shard is queried with all nodes of its own and of the label's other shards (each pair of
   shards in one task, which counts links for both).  Before that, an audit compares a sample of the
   queries with all nodes of the shard; the beam widens until the audit finds every node in reach and
   the nearest node of 90 % of the queries.  A query whose beam ends inside its reach widens it further.
4. Two balls so close that all their members must link (by the angles of centres and radii) are
   counted at once, without listing pairs; two balls too far apart are dropped.  All others are verified
   in doubles, member by member.  A task returns one row per node: how many it links to, and one root.
5. Roots are united to components over all shards (:mod:`components`).

The graphs are written to the shared folder, so that a lost executor costs single shards.  No list of
vectors or links reaches the driver.  Work grows with the number of a label's shards, as each is
searched by all of its vectors.

Vectors that are null, empty or zero, or that hold null, NaN or infinite components, and rows with a
null label or a null vec_id link with nothing and stay.  Rows that repeat a vec_id are vectors of their
own.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.blocks import mix
from marketflow.llm.components import connected_components, local_roots
from marketflow.llm.hnsw import Graph, pack, unpack
from marketflow.llm.shipping import ship_package
from marketflow.llm.vectors import is_finite, matrix
from marketflow.session import stored

LEAST_COSINE = 0.93
#: A shard holds up to this many numbers (8 MB of single floats), so that a graph fits a task many times over.
SHARD_NUMBERS = 1 << 21
#: Queries of an audit, and the least share of them whose nearest node must be found.
AUDIT, AUDIT_NEAREST = 256, 0.9
FIRST_BEAM = 24
#: Angles nearer than this (radians) to a bound are verified.
SLACK = 1e-6
#: Graphs work in single floats: a ball is by this much smaller than the angle allows.
ABSORB_SLACK = 1e-4
ROWS = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square overflows or vanishes."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Shard:
    """One shard's vectors (unit, double), copies, node numbers, graph and balls."""

    def __init__(self, number: np.ndarray, copies: np.ndarray, raw: np.ndarray, cosine: float, graph: dict | None = None):
        self.number, self.copies, self.raw, self.x = number, copies, raw, unit(raw.astype(np.float64))
        half = np.arccos(cosine) / 2
        absorb = np.cos(max(half - ABSORB_SLACK, 0.0))
        self.graph = Graph(self.x, absorb) if graph is None else Graph.load(self.x, graph)
        self.leads = self.graph.nodes()
        self.ball = np.searchsorted(self.leads, self.graph.node)
        order = np.argsort(self.ball, kind="stable")
        first = np.searchsorted(self.ball[order], np.arange(len(self.leads) + 1))
        self.members, self.first = order, first
        mean = np.add.reduceat(self.x[order], first[:-1], axis=0)
        single = np.diff(first) == 1
        mean[single] = self.x[self.leads[single]]
        self.centre = unit(mean)
        self.radius = np.where(single, 0.0, self._reach(self.centre))
        self.reach = np.where(single, 0.0, self._reach(self.x[self.leads]))
        self.mass = np.add.reduceat(copies[order], first[:-1])

    def _reach(self, middle: np.ndarray) -> np.ndarray:
        """The largest angle of each ball's members to a vector."""
        cos = np.einsum("ij,ij->i", self.x, middle[self.ball])
        return np.arccos(np.clip(np.minimum.reduceat(cos[self.members], self.first[:-1]), -1, 1))

    def of(self, ball: int) -> np.ndarray:
        return self.members[self.first[ball] : self.first[ball + 1]]

    def save(self) -> bytes:
        return pack({"number": self.number, "copies": self.copies, "raw": self.raw, **self.graph.save()})

    @classmethod
    def load(cls, data: bytes, cosine: float) -> Shard:
        saved = unpack(data)
        return cls(saved["number"], saved["copies"], saved["raw"], cosine, saved)


def audited_beam(index: Shard, q: np.ndarray, cut: np.ndarray, own: bool) -> tuple[int, float]:
    """The least beam (doubled from ``FIRST_BEAM``) that passes on a sample of the queries, and its recall
    of nearest nodes.  Where the queries are the ``own`` nodes, finding oneself does not count."""
    pick = np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int)
    q, cut = q[pick], cut[pick]
    itself = index.leads[pick, None] if own else np.full((len(pick), 1), -1)
    every = q @ index.x[index.leads].T
    every[index.leads[None, :] == itself] = -np.inf
    wanted = every >= cut[:, None]
    best = every.max(1)
    beam = FIRST_BEAM
    while True:
        ids, cos = index.graph.search(q, beam)
        last = cos[:, -1].copy()
        cos[ids == itself] = -np.inf
        found = (cos >= cut[:, None] - 1e-6).sum(1)
        lacks = (found < wanted.sum(1)) & (last < cut)  # a beam that ends inside the reach is widened anyway
        nearest = float((cos.max(1) >= best - 1e-5).mean())
        if beam >= len(index.leads) or not lacks.any() and nearest >= AUDIT_NEAREST:
            return beam, nearest
        beam *= 2


def near_balls(index: Shard, queries: Shard, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (ball of ``queries``, ball of ``index``) whose nodes are near enough for members to link."""
    angle = np.arccos(cosine) + queries.reach + index.reach.max() + SLACK
    cut = np.where(angle < np.pi, np.cos(np.minimum(angle, np.pi)), -1.0)
    q = queries.x[queries.leads]
    beam, _ = audited_beam(index, q, cut, index is queries)
    left, right = [], []
    todo = np.arange(len(q))
    while len(todo):
        if beam < len(index.leads):
            ids, cos = index.graph.search(q[todo], beam)
            inside = (cos >= cut[todo, None] - 1e-6) & (ids < index.graph.none)
            open_ = inside[:, -1]
            a, b = np.nonzero(inside & ~open_[:, None])
            left.append(todo[a])
            right.append(np.searchsorted(index.leads, ids[a, b]))
            todo, beam = todo[open_], 2 * beam
        else:  # a beam as wide as the graph is the graph
            for k in range(0, len(todo), ROWS):
                part = todo[k : k + ROWS]
                a, b = np.nonzero(q[part] @ index.x[index.leads].T >= cut[part, None] - 1e-6)
                left.append(part[a])
                right.append(b)
            break
    return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def count_links(one: Shard, two: Shard, a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs of balls: links counted for the rows of ``one`` and of ``two``, and which pairs hold a link."""
    more_one, more_two = np.zeros(len(one.x), np.int64), np.zeros(len(two.x), np.int64)
    ball_one, ball_two = np.zeros(len(one.leads), np.int64), np.zeros(len(two.leads), np.int64)
    limit = np.arccos(cosine)
    apart = np.arccos(np.clip(np.einsum("ij,ij->i", one.centre[a], two.centre[b]), -1, 1))
    wide = one.radius[a] + two.radius[b]
    single = wide == 0
    all_link = ~single & (apart + wide < limit - SLACK)
    links = all_link.copy()
    np.add.at(ball_one, a[all_link], two.mass[b[all_link]])
    np.add.at(ball_two, b[all_link], one.mass[a[all_link]])
    s = np.flatnonzero(single)
    s = s[np.einsum("ij,ij->i", one.x[one.leads[a[s]]], two.x[two.leads[b[s]]]) >= cosine]
    links[s] = True
    np.add.at(ball_one, a[s], two.mass[b[s]])
    np.add.at(ball_two, b[s], one.mass[a[s]])
    for k in np.flatnonzero(~single & ~all_link & (apart - wide <= limit + SLACK)).tolist():
        left, right = one.of(a[k]), two.of(b[k])
        for i in range(0, len(left), ROWS):
            for j in range(0, len(right), ROWS):
                x, y = left[i : i + ROWS], right[j : j + ROWS]
                near = one.x[x] @ two.x[y].T >= cosine
                more_one[x] += near @ two.copies[y]
                more_two[y] += one.copies[x] @ near
                links[k] |= bool(near.any())
    return more_one + ball_one[one.ball], more_two + ball_two[two.ball], links


RESULT = ["node", "more", "root", "shard", "data"]


def _rows(number: np.ndarray, more: np.ndarray, root: np.ndarray, shard: int | None = None, data: bytes | None = None) -> pa.Table:
    """Rows of linked nodes, and one with the shard itself."""
    some = np.flatnonzero((more > 0) | (root != number))
    n = len(some)
    tail = [] if data is None else [data]
    return pa.table(
        [
            pa.array([*number[some].tolist(), *[None] * len(tail)], pa.int64()),
            pa.array([*more[some].tolist(), *[None] * len(tail)], pa.int64()),
            pa.array([*root[some].tolist(), *[None] * len(tail)], pa.int64()),
            pa.array([None] * n + [shard] * len(tail), pa.int64()),
            pa.array([None] * n + tail, pa.binary()),
        ],
        RESULT,
    )


def _build(cosine: float, keep: bool) -> Callable[[pa.Table], pa.Table]:
    def build(group: pa.Table) -> pa.Table:
        number = group["node"].to_numpy()
        order = np.argsort(mix(number.astype(np.uint64)))
        raw = matrix(group["embedding"].combine_chunks(), group["embedding"].type.value_type.to_pandas_dtype())
        own = Shard(number[order], group["copies"].to_numpy()[order], raw[order], cosine)
        a, b = near_balls(own, own, cosine)
        once = a != b
        low, high = np.minimum(a[once], b[once]), np.maximum(a[once], b[once])
        pairs = np.unique(low * len(own.leads) + high)  # found from one side is enough
        a, b = pairs // len(own.leads), pairs % len(own.leads)
        left, right, links = count_links(own, own, a, b, cosine)
        more = left + right + own.mass[own.ball] - own.copies  # all members of a ball link
        root = local_roots(len(own.leads), a[links], b[links])
        data = own.save() if keep else None
        shard = group["shard"][0].as_py()
        return _rows(own.number, more, own.number[own.leads[root]][own.ball], shard, data)

    return build


def _compare(cosine: float) -> Callable[[pa.Table], pa.Table]:
    def compare(group: pa.Table) -> pa.Table:
        data = [x.as_py() for _, x in sorted(zip(group["shard"].to_pylist(), group["data"]))]
        one, two = (Shard.load(x, cosine) for x in data)
        a, b = near_balls(two, one, cosine)
        left, right, links = count_links(one, two, a, b, cosine)
        n = len(one.leads)
        root = local_roots(n + len(two.leads), a[links], n + b[links])
        lead = np.concatenate([one.number[one.leads], two.number[two.leads]])
        # members are tied to their node by their own shard's task; here only nodes need a root
        root_one, root_two = one.number.copy(), two.number.copy()
        root_one[one.leads], root_two[two.leads] = lead[root[:n]], lead[root[n:]]
        return pa.concat_tables([_rows(one.number, left, root_one), _rows(two.number, right, root_two)])

    return compare


def _linked(nodes: DataFrame, cosine: float, shard_numbers: int) -> DataFrame:
    """(node, more, root) of linked nodes, several rows for a node where it has links in several shards."""
    spark = nodes.sparkSession
    ship_package(spark)
    sizes = nodes.groupBy("label", "dims").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("shards", F.ceil(F.col("n") * F.col("dims") / F.lit(shard_numbers)).cast("long"))
    most = sizes.agg(F.max("shards")).first()[0] or 0
    if most > 1:
        dealt = nodes.join(sizes.drop("n"), ["label", "dims"])
        dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")))
    else:
        dealt = nodes.withColumn("shard", F.lit(0).cast("long"))
    columns = ["label", "dims", "shard", "node", "copies", "embedding"]
    schema = "node long, more long, root long, shard long, data binary"
    label = f"label {nodes.schema['label'].dataType.simpleString()}, dims int"
    grouped = dealt.select(columns).groupBy("label", "dims", "shard")
    built = stored(grouped.applyInArrow(_labelled(_build(cosine, most > 1)), f"{label}, {schema}"), "vector-graphs")
    links = built.where("node is not null").select("node", "more", "root")
    if most <= 1:
        return links
    shards = built.where("data is not null").select("label", "dims", "shard", "data").join(sizes.drop("n"), ["label", "dims"])
    other = shards.where("shards > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    pairs = other.where("other != shard").select(
        "label", "dims", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"), "shard", "data"
    )
    across = pairs.groupBy("label", "dims", "low", "high").applyInArrow(_compare(cosine), schema)
    return links.unionByName(stored(across, "vector-links").select("node", "more", "root"))


def _labelled(build: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """Adds the group's label and length to the rows of a task."""

    def run(group: pa.Table) -> pa.Table:
        out = build(group)
        first = [pa.repeat(group[name][0], out.num_rows) for name in ("label", "dims")]
        return pa.table([*first, *out.columns], ["label", "dims", *RESULT])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = LEAST_COSINE, shard_numbers: int = SHARD_NUMBERS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    fine = is_finite("embedding") & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    fine = fine & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    may = rows.where(fine)
    nodes = may.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = nodes.withColumn("dims", F.size("embedding")).withColumn("node", F.monotonically_increasing_id())
    nodes = stored(nodes, "vector-nodes")
    links = stored(_linked(nodes, cosine, shard_numbers), "vector-links")
    roots = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    more = links.groupBy("node").agg(F.sum("more").alias("more"))
    info = nodes.join(more, "node", "left").join(roots, "node", "left")
    info = info.select(
        "label", "embedding", "least", F.coalesce("root", "node").alias("root"),
        (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"),
    )
    info = stored(info, "vector-info")
    named = info.groupBy("root").agg(F.min("least").alias("component_id"))
    info = info.join(named, "root").select("label", "embedding", "n_links", "component_id")
    found = may.join(info, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE fine AS (
  SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL)
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine AS a JOIN fine AS b USING (label)
  WHERE a.vec_id <> b.vec_id AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
"""
