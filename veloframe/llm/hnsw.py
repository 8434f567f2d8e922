"""A hierarchical navigable small-world graph in numpy; many points are inserted and many queries answered in step.

Points enter by descending level, in batches: a batch finds its neighbours in the graph so far and among itself, keeps those that
are nearer to it than to each other (the usual heuristic; the rest fill what is free), and links back. Similarity is the
dot product of unit vectors.
"""

from __future__ import annotations

import io

import numpy as np


class Graph:
    def __init__(self, vectors: np.ndarray, degree: int = 12, breadth: int = 48, batch: int = 512, seed: int = 7):
        self.x = np.ascontiguousarray(vectors, np.float32)
        self.n, self.degree, self.breadth = len(vectors), degree, breadth
        draw = np.random.default_rng(seed).random(self.n)
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(degree)).astype(np.int64), 8)
        top = int(self.level.max()) if self.n else 0
        self.near = [np.full((self.n, degree * 2 if lv == 0 else degree), -1, np.int32) for lv in range(top + 1)]
        order = np.argsort(-self.level, kind="stable")
        self.entry = int(order[0]) if self.n else -1
        at = 1
        while at < self.n:
            size = min(batch, at)
            self._insert(order[at : at + size])
            at += size
        self._connect()

    def _reach(self, start: int, seen: np.ndarray) -> None:
        """Mark what the lowest level leads to."""
        seen[start], front = True, np.array([start])
        while len(front):
            front = np.unique(self.near[0][front])
            front = front[front >= 0]
            front = front[~seen[front]]
            seen[front] = True

    def _connect(self) -> None:
        """One more place for each point on the lowest level, which bridges to points that nothing leads to: a beam as wide as the graph sees all of it."""
        if not self.n:
            return
        self.near[0] = np.hstack([self.near[0], np.full((self.n, 1), -1, np.int32)])
        seen, at = np.zeros(self.n, bool), 0
        self._reach(self.entry, seen)
        while at < self.n:
            if seen[at]:
                at += 1
                continue
            ids = self.search(self.x[at : at + 1], self.breadth)[0][0]
            free = [i for i in ids[ids >= 0].tolist() if self.near[0][i, -1] < 0] or np.flatnonzero(seen & (self.near[0][:, -1] < 0))[:1].tolist()
            self.near[0][free[0], -1] = at
            self._reach(at, seen)

    def dumped(self) -> bytes:
        """The graph without its points."""
        out = io.BytesIO()
        np.savez(out, level=self.level.astype(np.int8), entry=self.entry, **{f"near{i}": a for i, a in enumerate(self.near)})
        return out.getvalue()

    @classmethod
    def loaded(cls, raw: bytes, vectors: np.ndarray) -> Graph:
        out, found = cls.__new__(cls), np.load(io.BytesIO(raw))
        out.x, out.level, out.entry = np.ascontiguousarray(vectors, np.float32), found["level"], int(found["entry"])
        out.n = len(out.x)
        out.near = [found[f"near{i}"] for i in range(sum(k.startswith("near") for k in found.files))]
        return out

    def _sims(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Similarities of each query to its row of points; -2 where there is none."""
        return np.where(ids >= 0, np.matmul(self.x[ids], q[:, :, None])[:, :, 0], -2)

    def beam(self, q: np.ndarray, start: np.ndarray, level: int, width: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best points found for each query on a level, best first (-1 beyond); start: a point for each."""
        rows, near = np.arange(len(q)), self.near[level]
        ids = np.full((len(q), width), -1, np.int64)
        ids[:, 0] = start
        sims = np.full((len(q), width), -2, np.float32)
        sims[:, 0] = self._sims(q, start[:, None])[:, 0]
        done, seen = ids < 0, np.zeros((len(q), self.n), bool)
        seen[rows, start] = True
        expand = min(expand, width)
        while len(live := np.flatnonzero(~done.all(axis=1))):
            pick = np.argsort(done[live], axis=1, kind="stable")[:, :expand]
            chosen = np.where(done[live[:, None], pick], -1, ids[live[:, None], pick])
            done[live[:, None], pick] = True
            new = np.where(chosen[:, :, None] >= 0, near[chosen], -1).reshape(len(live), -1)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new = np.where((new >= 0) & ~seen[live[:, None], new], new, -1)
            r, c = np.nonzero(new >= 0)
            seen[live[r], new[r, c]] = True
            s = np.full(new.shape, -2, np.float32)
            s[r, c] = np.einsum("ij,ij->i", self.x[new[r, c]], q[live[r]])
            all_sims = np.concatenate([sims[live], s], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            take = lambda a, b: np.take_along_axis(np.concatenate([a, b], axis=1), best, axis=1)
            sims[live] = np.take_along_axis(all_sims, best, axis=1)
            ids[live] = take(ids[live], new)
            done[live] = take(done[live], new < 0)
        return ids, sims

    def _chosen(self, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
        """For each row of candidates, best first: up to ``keep`` of them, spread out before near ones fill the rest."""
        points = self.x[ids]
        among = np.matmul(points, points.transpose(0, 2, 1))
        chosen, count = np.zeros(ids.shape, bool), np.zeros(len(ids), np.int64)
        for c in range(ids.shape[1]):
            apart = ~((among[:, c] > sims[:, c, None]) & chosen).any(axis=1)
            chosen[:, c] = apart & (ids[:, c] >= 0) & (count < keep)
            count += chosen[:, c]
        order = np.argsort(np.where(ids < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :keep]
        out = np.take_along_axis(ids, order, axis=1)
        return out

    def _insert(self, new: np.ndarray) -> None:
        q = self.x[new]
        start = np.full(len(new), self.entry)
        for level in range(len(self.near) - 1, -1, -1):
            stay = self.level[new] < level
            if stay.any():
                start[stay] = self.beam(q[stay], start[stay], level, 1, 1)[0][:, 0]
            own = np.flatnonzero(~stay)
            if not len(own):
                continue
            ids, sims = self.beam(q[own], start[own], level, self.breadth)
            start[own] = ids[:, 0]
            mates = q[own] @ q[own].T
            np.fill_diagonal(mates, -2)
            k = min(16, len(own))
            best = np.argpartition(-mates, k - 1, axis=1)[:, :k]
            mate_sims = np.take_along_axis(mates, best, axis=1)
            ids = np.concatenate([ids, np.where(mate_sims > -2, new[own][best], -1)], axis=1)
            sims = np.concatenate([sims, mate_sims], axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
            links = self._chosen(ids, sims, self.degree)
            self.near[level][new[own], : links.shape[1]] = links
            self._link_back(level, np.repeat(new[own], links.shape[1]), links.ravel())

    def _link_back(self, level: int, source: np.ndarray, to: np.ndarray) -> None:
        near, cap = self.near[level], self.near[level].shape[1]
        source, to = source[to >= 0], to[to >= 0]
        sims = np.einsum("ij,ij->i", self.x[source], self.x[to])
        order = np.lexsort((-sims, to))
        source, to = source[order], to[order]
        first = np.flatnonzero(np.diff(to, prepend=-1))
        rank = np.arange(len(to)) - np.repeat(first, np.diff(np.append(first, len(to))))
        ok = rank < cap
        nodes = to[first]
        more = np.full((len(nodes), cap), -1, np.int64)
        more[np.searchsorted(nodes, to[ok]), rank[ok]] = source[ok]
        for lo in range(0, len(nodes), 512):
            own = nodes[lo : lo + 512]
            ids = np.sort(np.concatenate([near[own], more[lo : lo + 512]], axis=1), axis=1)[:, ::-1].copy()
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = self._sims(self.x[own], ids)
            order = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
            over = (ids >= 0).sum(axis=1) > cap
            kept = ids[:, :cap].copy()
            if over.any():
                kept[over] = self._chosen(ids[over], sims[over], cap)
            near[own] = kept

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` points for each query."""
        start = np.full(len(q), self.entry)
        for level in range(len(self.near) - 1, 0, -1):
            start = self.beam(q, start, level, 1, 1)[0][:, 0]
        return self.beam(q, start, 0, min(width, self.n), max(4, width // 8))
