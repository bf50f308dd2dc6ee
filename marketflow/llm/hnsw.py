"""A navigable small-world graph with levels, built and searched for many queries side by side.

Nodes are unit vectors, inserted in the order given (callers shuffle it) in batches that grow with the
graph.  A batch is searched in the graph so far and compared with itself, and every new node links to
near nodes in different directions, on its level and all below; these link back and keep the best.
A vector within the absorbing cosine of a node becomes a member of that node instead of a node, so
that thousands of near copies are one node.  A search walks down the levels and ends in a beam on the
lowest one; all queries of a block take each step together, in numpy.
"""

from __future__ import annotations

import io

import numpy as np

LINKS, LOW_LINKS = 12, 20
BUILD_BEAM, HIGH_BEAM = 32, 6
LEAST_BATCH, MOST_BATCH = 32, 1024
#: Queries that share one table of visited nodes.
BLOCK = 256


class Graph:
    def __init__(self, vectors: np.ndarray, absorb: float):
        """``vectors`` (row, component) of length 1; rows of cosine ``absorb`` to a node join it."""
        n, d = vectors.shape
        self.x = np.zeros((n + 1, d), np.float32)  # the last row stands for no node
        self.x[:n] = vectors
        self.none = n
        rng = np.random.default_rng(n)
        self.level = np.minimum(-np.log(rng.random(n) + 1e-300) / np.log(LINKS), 6).astype(np.int64)
        self.link = [np.full((n + 1, LOW_LINKS if k == 0 else LINKS), n, np.int32) for k in range(int(self.level.max(initial=0)) + 1)]
        self.entry = self.top = -1
        #: The node whose member each row is (nodes: themselves).
        self.node = np.full(n, -1)
        done = 0
        while done < n:
            size = min(max(done // 4, LEAST_BATCH), MOST_BATCH)
            self._insert(np.arange(done, min(n, done + size)), absorb)
            done += size

    # -- search ---------------------------------------------------------------------------------

    def _beam(self, q: np.ndarray, start: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, beam) nodes and cosines in descending order, from ``start`` (query, some nodes)."""
        m, link = len(q), self.link[level]
        ids = np.full((m, beam + start.shape[1]), self.none, np.int32)
        cos = np.full(ids.shape, -np.inf, np.float32)
        visited = np.zeros((m, self.none + 1), bool)
        visited[:, self.none] = True
        rows = np.arange(m)
        ids[:, : start.shape[1]] = start
        cos[:, : start.shape[1]] = np.where(start < self.none, np.einsum("mkd,md->mk", self.x[start], q), -np.inf)
        visited[rows[:, None], start] = True
        order = np.argsort(-cos, axis=1, kind="stable")[:, :beam]
        ids, cos = np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)
        left = ids < self.none  # in the beam and not yet followed
        live = np.flatnonzero(left.any(1))
        while len(live):
            best = left[live].argmax(1)  # the beam is in order, so that the first is the best
            left[live, best] = False
            near = link[ids[live, best]]
            fresh = ~visited[live[:, None], near]
            visited[live[:, None], near] = True
            found = np.einsum("mkd,md->mk", self.x[near], q[live])
            found[~fresh] = -np.inf
            near = np.where(fresh, near, self.none)
            ids_all = np.concatenate([ids[live], near], axis=1)
            cos_all = np.concatenate([cos[live], found], axis=1)
            left_all = np.concatenate([left[live], fresh], axis=1)
            order = np.argsort(-cos_all, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(ids_all, order, 1)
            cos[live] = np.take_along_axis(cos_all, order, 1)
            left[live] = np.take_along_axis(left_all, order, 1)
            live = live[left[live].any(1)]
        return ids, cos

    def _down(self, q: np.ndarray, beam: int, high: int = HIGH_BEAM) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """The beams of all levels, from the top one down; ``high`` is the width above the lowest."""
        out, start = {}, np.full((len(q), 1), self.entry, np.int32)
        for level in range(self.top, -1, -1):
            out[level] = self._beam(q, start, level, high if level else beam)
            start = out[level][0][:, :HIGH_BEAM]
        return out

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, beam) nearest nodes found and their cosines, descending; missing ones are ``none`` and -inf."""
        if self.top < 0 or not len(q):
            return np.zeros((len(q), 0), np.int32), np.zeros((len(q), 0), np.float32)
        parts = [self._down(q[k : k + BLOCK].astype(np.float32), beam)[0] for k in range(0, len(q), BLOCK)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def nodes(self) -> np.ndarray:
        return np.flatnonzero(self.node == np.arange(self.none))

    # -- building -------------------------------------------------------------------------------

    def _insert(self, batch: np.ndarray, absorb: float) -> None:
        beams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if self.top >= 0:
            parts = [self._down(self.x[batch[k : k + BLOCK]], BUILD_BEAM, LINKS) for k in range(0, len(batch), BLOCK)]
            beams = {level: tuple(np.concatenate([p[level][i] for p in parts]) for i in (0, 1)) for level in parts[0]}
            near = beams[0][1][:, 0] >= absorb
            self.node[batch[near]] = beams[0][0][near, 0]
            batch, beams = batch[~near], {k: (v[0][~near], v[1][~near]) for k, v in beams.items()}
        own = self.x[batch] @ self.x[batch].T
        stays = self._leaders(batch, own, absorb)
        batch, own = batch[stays], own[np.ix_(stays, stays)]
        beams = {k: (v[0][stays], v[1][stays]) for k, v in beams.items()}
        if not len(batch):
            return
        self.node[batch] = batch
        np.fill_diagonal(own, -np.inf)
        for level in range(int(self.level[batch].max()), -1, -1):
            on = np.flatnonzero(self.level[batch] >= level)
            most = self.link[level].shape[1]
            own_on = own[np.ix_(on, on)]
            order = np.argsort(-own_on, axis=1, kind="stable")[:, : min(most, len(on))]
            ids, cos = batch[on][order].astype(np.int32), np.take_along_axis(own_on, order, 1)
            if level in beams:
                ids = np.concatenate([beams[level][0][on], ids], axis=1)
                cos = np.concatenate([beams[level][1][on], cos], axis=1)
            self._connect(batch[on], ids, cos, level)
        high = batch[np.argmax(self.level[batch])]
        if self.level[high] > self.top:
            self.top, self.entry = int(self.level[high]), int(high)

    def _leaders(self, batch: np.ndarray, own: np.ndarray, absorb: float) -> np.ndarray:
        """Which rows of a batch become nodes; the others join an earlier row of the batch."""
        close = own >= absorb
        np.fill_diagonal(close, False)
        stays = np.ones(len(batch), bool)
        for i in np.flatnonzero(close.any(1)).tolist():
            if stays[i]:
                joins = close[i] & stays
                joins[: i + 1] = False
                self.node[batch[joins]] = batch[i]
                stays &= ~joins
        return np.flatnonzero(stays)

    def _chosen(self, ids: np.ndarray, cos: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates up to ``most``: first those nearer to the row than to one chosen before."""
        order = np.argsort(-cos, axis=1, kind="stable")[:, : 2 * most]
        ids, cos = np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)
        v = self.x[ids]
        between = v @ v.transpose(0, 2, 1)
        real = np.isfinite(cos)
        chosen = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            blocked = np.where(chosen, between[:, j], -np.inf).max(1) >= cos[:, j]
            chosen[:, j] = real[:, j] & ~blocked & (chosen.sum(1) < most)
        # the remaining places go to the nearest of the others
        first = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
        picked = np.where(np.take_along_axis(real, first, 1), np.take_along_axis(ids, first, 1), self.none)
        if picked.shape[1] < most:
            picked = np.concatenate([picked, np.full((len(ids), most - picked.shape[1]), self.none)], axis=1)
        return picked.astype(np.int32)

    def _connect(self, rows: np.ndarray, ids: np.ndarray, cos: np.ndarray, level: int) -> None:
        link = self.link[level]
        most = link.shape[1]
        for k in range(0, len(rows), BLOCK):
            link[rows[k : k + BLOCK]] = self._chosen(ids[k : k + BLOCK], cos[k : k + BLOCK], most)
        there = link[rows]
        back = there.ravel().astype(np.int64)
        come = np.repeat(rows, most)[back < self.none]
        back = back[back < self.none]
        cos = np.einsum("kd,kd->k", self.x[back], self.x[come])
        order = np.lexsort((-cos, back))
        back, come, cos = back[order], come[order], cos[order]
        first = np.flatnonzero(np.diff(back, prepend=-1))
        place = np.arange(len(back)) - np.repeat(first, np.diff(first, append=len(back)))
        few = place < most  # the nearest ones of those that link to the same node
        new = np.full((len(first), most), self.none, np.int32)
        slot = np.repeat(np.arange(len(first)), np.diff(first, append=len(back)))
        new[slot[few], place[few]] = come[few]
        nodes = back[first]
        for k in range(0, len(nodes), BLOCK):
            part = nodes[k : k + BLOCK]
            both = np.sort(np.concatenate([link[part], new[k : k + BLOCK]], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = self.none
            near = np.einsum("mkd,md->mk", self.x[both], self.x[part])
            near[both == self.none] = -np.inf
            link[part] = self._chosen(both, near, most)

    # -- storing --------------------------------------------------------------------------------

    def save(self) -> dict[str, np.ndarray]:
        return {"level": self.level, "node": self.node, "entry": np.array([self.entry, self.top]), **{f"link{k}": a for k, a in enumerate(self.link)}}

    @classmethod
    def load(cls, vectors: np.ndarray, saved: dict[str, np.ndarray]) -> Graph:
        out = cls.__new__(cls)
        n, d = vectors.shape
        out.x = np.zeros((n + 1, d), np.float32)
        out.x[:n] = vectors
        out.none, out.level, out.node = n, saved["level"], saved["node"]
        out.entry, out.top = (int(v) for v in saved["entry"])
        out.link = [saved[f"link{k}"] for k in range(sum(name.startswith("link") for name in saved))]
        return out


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as found:
        return {name: found[name] for name in found.files}
