"""Hierarchical navigable small-world graphs over unit vectors, with many queries walking side by side."""

from __future__ import annotations

import io

import numpy as np

LINKS = 16
BUILD_BEAM = 48
BATCH = 256
EXPAND = 4


def _top(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each row, best first, and their columns."""
    if sims.shape[1] > k:
        at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    else:
        at = np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    at = np.take_along_axis(at, np.argsort(-np.take_along_axis(sims, at, 1), axis=1, kind="stable"), 1)
    return np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1), at


class Graph:
    """Layers of links; layer 0 has all vectors, each further one about a ``LINKS``-th of the layer below.

    Vectors are inserted from the highest layer downwards, a batch at a time:
    a batch is searched in the graph so far and compared with itself.  A vector
    is linked to near ones in different directions first, then to the nearest.
    """

    def __init__(self, x: np.ndarray, seed: int = 11):
        self.x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        draw = np.random.default_rng(seed).random(n)
        self.layer = np.minimum(-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS), 8).astype(int)
        self.links = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int32) for k in range(int(self.layer.max(initial=0)) + 1)]
        self.entry = np.zeros(0, np.int64)
        self._build()

    def _build(self) -> None:
        order = np.argsort(-self.layer, kind="stable")
        self.entry = order[:1]
        done, size = 1, 1
        while done < len(order):
            new = order[done:done + size]
            entries = np.broadcast_to(self.entry, (len(new), 1))
            for k in range(len(self.links) - 1, -1, -1):
                part = self.layer[new] >= k
                found, sims = self._walk(self.x[new], entries, k, BUILD_BEAM if part.any() else 1)
                entries = found[:, : min(4, found.shape[1])]
                own = new[part]
                if len(own):
                    self._link(own, found[part], k)
            done += len(new)
            size = min(BATCH, done)

    def _link(self, own: np.ndarray, found: np.ndarray, k: int) -> None:
        mates = np.broadcast_to(own, (len(own), len(own)))
        sims = self.x[own] @ self.x[own].T
        np.fill_diagonal(sims, -np.inf)
        near, _, _ = _top(mates, sims, min(LINKS, len(own)))
        near = np.where(near == own[:, None], -1, near)
        self._choose(own, np.concatenate([found, near], axis=1), k)
        # links back: what points to a node stands for choice beside what it has
        target = self.links[k][own].ravel()
        source = np.repeat(own, self.links[k].shape[1])
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        width = self.links[k].shape[1]
        for start in range(0, len(nodes), 1024):
            part = slice(start, start + 1024)
            most = min(int(count[part].max()), 2 * width)
            offers = np.full((len(nodes[part]), most), -1, np.int64)
            for j in range(most):
                has = count[part] > j
                # an even choice of the offers of a node with very many
                at = first[part] + (j * count[part]) // np.maximum(np.minimum(count[part], most), 1)
                offers[has, j] = source[at[has]]
            self._choose(nodes[part], np.concatenate([self.links[k][nodes[part]], offers], axis=1), k)

    def _choose(self, own: np.ndarray, candidates: np.ndarray, k: int) -> None:
        width = self.links[k].shape[1]
        candidates = np.sort(candidates, axis=1)
        again = np.zeros(candidates.shape, bool)
        again[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
        candidates = np.where(again | (candidates == own[:, None]), -1, candidates)
        sims = np.einsum("bkd,bd->bk", self.x[np.maximum(candidates, 0)], self.x[own])
        sims = np.where(candidates < 0, -np.inf, sims)
        ids, sims, _ = _top(candidates, sims, min(candidates.shape[1], 2 * width))
        v = self.x[np.maximum(ids, 0)]
        among = v @ v.transpose(0, 2, 1)
        apart = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            closer = ((among[:, j, :j] > sims[:, j, None]) & apart[:, :j]).any(axis=1)
            apart[:, j] = ~closer & (sims[:, j] > -np.inf) & (apart[:, :j].sum(axis=1) < width // 2)
        rank = np.where(apart, sims + 4, sims)
        best, value, _ = _top(ids, rank, min(width, ids.shape[1]))
        self.links[k][own] = -1
        self.links[k][own, : best.shape[1]] = np.where(value > -np.inf, best, -1)

    def _walk(self, q: np.ndarray, entries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the beam of each query on layer ``k``, best first; -1 where it is not full."""
        b = len(q)
        seen = np.zeros((b, len(self.x)), bool)
        rows = np.arange(b)
        entries = np.sort(entries, axis=1)
        fresh = np.ones(entries.shape, bool)
        fresh[:, 1:] = entries[:, 1:] != entries[:, :-1]
        fresh &= entries >= 0
        ids = np.full((b, beam), -1, np.int64)
        sims = np.full((b, beam), -np.inf, np.float32)
        first = np.where(fresh, np.einsum("bkd,bd->bk", self.x[np.maximum(entries, 0)], q), -np.inf)
        ids_0, sims_0, _ = _top(np.where(fresh, entries, -1), first, min(beam, entries.shape[1]))
        ids[:, : ids_0.shape[1]], sims[:, : ids_0.shape[1]] = ids_0, sims_0
        r, c = np.nonzero(fresh)
        seen[r, entries[r, c]] = True
        open_ = ids >= 0
        live = rows
        while len(live):
            todo = np.where(open_[live], sims[live], -np.inf)
            width = min(EXPAND, beam)
            at = np.argpartition(-todo, width - 1, axis=1)[:, :width] if beam > width else np.broadcast_to(np.arange(beam), todo.shape)
            picked = np.take_along_axis(todo, at, 1) > -np.inf
            live_rows = picked.any(axis=1)
            live, at, picked = live[live_rows], at[live_rows], picked[live_rows]
            if not len(live):
                break
            open_[live[:, None], at] &= ~picked
            near = self.links[k][np.where(picked, ids[live[:, None], at], 0)]
            near = np.where(picked[:, :, None], near, -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            new = near >= 0
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            new &= ~seen[live[:, None], np.maximum(near, 0)]
            keep = new.any(axis=0)
            near, new = near[:, keep].astype(np.int64), new[:, keep]
            if not near.shape[1]:
                continue
            r, c = np.nonzero(new)
            seen[live[r], near[r, c]] = True
            value = np.where(new, np.einsum("bkd,bd->bk", self.x[np.maximum(near, 0)], q[live]), -np.inf)
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_open = np.concatenate([open_[live], new], axis=1)
            best_ids, best, at = _top(all_ids, np.concatenate([sims[live], value], axis=1), beam)
            ids[live], sims[live] = np.where(best > -np.inf, best_ids, -1), best
            open_[live] = np.take_along_axis(all_open, at, 1) & (best > -np.inf)
        return ids, sims

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entries = np.broadcast_to(self.entry, (len(q), 1))
        for k in range(len(self.links) - 1, 0, -1):
            entries = self._walk(q, entries, k, 4)[0]
        return self._walk(q, entries, 0, beam)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, x=self.x, layer=self.layer, entry=self.entry, **{f"links{k}": v for k, v in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Graph:
        held = np.load(io.BytesIO(blob))
        self = cls.__new__(cls)
        self.x, self.layer, self.entry = held["x"], held["layer"], held["entry"]
        self.links = [held[f"links{k}"] for k in range(sum(n.startswith("links") for n in held.files))]
        return self


def near(graph: Graph, q: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
    """Candidates of each query with similarity of about ``least`` or more.

    The beam of a query widens fourfold while it ends above ``least``, for then
    more may lie beyond it.  A beam of an eighth of the graph is a scan.
    """
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
    slack = least - 1e-4
    for start in range(0, len(q), BATCH):
        todo = np.arange(start, min(start + BATCH, len(q)))
        width = beam
        while len(todo):
            if width * 8 >= len(graph.x):
                hits = q[todo] @ graph.x.T >= slack
                for i, row in zip(todo, hits):
                    out[i] = np.flatnonzero(row)
                break
            ids, sims = graph.search(q[todo], width)
            for i, row, sim in zip(todo, ids, sims):
                out[i] = row[sim >= slack]
            todo = todo[sims[:, -1] >= slack]
            width *= 4
    return out


def audited_beam(graph: Graph, least: float, beam: int, share: float, least_queries: int) -> int:
    """The first of ``beam``, twice that and so on with which a sample of the vectors finds all its links in the graph.

    The sample is compared with the whole graph.  A beam that would scan passes by itself.
    """
    n = len(graph.x)
    sample = np.random.default_rng(3).permutation(n)[: max(least_queries, int(n * share))]
    links = [np.flatnonzero(row) for start in range(0, len(sample), BATCH)
             for row in graph.x[sample[start:start + BATCH]] @ graph.x.T >= least + 1e-4]
    while beam * 8 < n:
        found = near(graph, graph.x[sample], least, beam)
        if all(np.isin(a, b).all() for a, b in zip(links, found)):
            break
        beam *= 2
    return beam
