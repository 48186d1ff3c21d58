"""Approximate nearest neighbours by a robust-pruned directed graph in each shard.

Points enter in growing batches. A greedy beam search over the graph so far proposes neighbours; pruning walks them from near to far and drops those
that a kept one is closer to by the factor alpha, so that kept edges point in different directions; edges back are added and pruned alike.
A query runs the same beam search in every shard, and the points of its beam get exact scores. Equal vectors share a point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import vector_shards

TOP, EVERY = 5, 50
SHARD_ROWS = 8192
DEGREE = 32
BUILD_BEAM, SEARCH_BEAM = 48, 128
ALPHA = 1.1
EXPANDED = 4  # points of a beam whose edges are followed at a time
ENTRIES = 8
BLOCK = 256


class Graph:
    """A directed graph over unit vectors; distances are squared and Euclidean."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
        self.points, self.degree, self.alpha = points, degree, alpha * alpha
        n = len(points)
        self.edges = np.full((n, degree), -1, "i4")
        order = np.random.default_rng(3).permutation(n)
        centre = int(np.argmax(points @ points.mean(0)))
        self.entries = np.unique(np.append(order[: ENTRIES - 1], centre))
        done, batch = 1, 1
        order = np.append(centre, order[order != centre])
        while done < n:
            rows = order[done : done + batch]
            for a in range(0, len(rows), BLOCK):
                self._insert(rows[a : a + BLOCK], order[: min(done, ENTRIES)], beam)
            done += len(rows)
            batch = min(2 * batch, max(BLOCK // 8, n // 50))

    def _insert(self, rows: np.ndarray, entries: np.ndarray, beam: int) -> None:
        found, _ = self.beams(self.points[rows], entries, beam)
        found[found == rows[:, None]] = -1
        self.edges[rows] = self._pruned(rows, found)
        heads = self.edges[rows]
        pairs = np.stack([heads.ravel(), np.repeat(rows, heads.shape[1])], 1)
        pairs = pairs[pairs[:, 0] >= 0]
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        targets, first, counts = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        wide = np.full((len(targets), int(counts.max(initial=0))), -1, "i4")
        wide[np.repeat(np.arange(len(targets)), counts), np.arange(len(pairs)) - np.repeat(first, counts)] = pairs[:, 1]
        both = np.concatenate([self.edges[targets], wide], 1)
        full = (both >= 0).sum(1) > self.degree
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, : self.degree]
        self.edges[targets[~full]] = packed[~full]
        hot = np.flatnonzero(full)
        for a in range(0, len(hot), BLOCK):
            part = hot[a : a + BLOCK]
            self.edges[targets[part]] = self._pruned(targets[part], both[part])

    def _pruned(self, rows: np.ndarray, found: np.ndarray) -> np.ndarray:
        """At most `degree` of each row's candidates; -1 is none."""
        vectors = self.points[found]
        away = 2 - 2 * np.einsum("rcd,rd->rc", vectors, self.points[rows])
        away[found < 0] = np.inf
        order = np.argsort(away, axis=1, kind="stable")
        found, away = np.take_along_axis(found, order, 1), np.take_along_axis(away, order, 1)
        vectors = np.take_along_axis(vectors, order[:, :, None], 1)
        between = 2 - 2 * vectors @ vectors.transpose(0, 2, 1)
        open_, kept = np.isfinite(away), np.full((len(rows), self.degree), -1, "i4")
        each = np.arange(len(rows))
        for slot in range(self.degree):
            if not open_.any():
                break
            nearest = open_.argmax(1)
            has = open_[each, nearest]
            kept[has, slot] = found[each, nearest][has]
            covered = self.alpha * between[each, nearest] <= away
            open_ &= ~(covered & has[:, None])
            open_[each, nearest] = False
        return kept

    def beams(self, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each query after the search: points, nearest first, and distances; -1 is none."""
        q, each = len(queries), np.arange(len(queries))[:, None]
        seen = np.zeros((q, len(self.points) + 1), bool)  # the last column is for none
        seen[:, -1] = True
        ids = np.full((q, beam), -1, "i4")
        near = np.full((q, beam), np.inf, "f4")
        first = entries[:beam]
        ids[:, : len(first)], near[:, : len(first)] = first, 2 - 2 * queries @ self.points[first].T
        seen[:, first] = True
        waiting = ids >= 0
        while waiting.any():
            ahead = np.where(waiting, near, np.inf)
            take = np.argpartition(ahead, EXPANDED - 1, axis=1)[:, :EXPANDED] if beam > EXPANDED else np.tile(np.arange(beam), (q, 1))
            valid = np.take_along_axis(waiting, take, 1)
            np.put_along_axis(waiting, take, False, 1)
            spread = np.where(valid[:, :, None], self.edges[np.take_along_axis(ids, take, 1)], -1).reshape(q, -1)
            fresh = ~seen[each, spread]
            # A point may come from two edges at once; the second is dropped.
            order = np.argsort(spread, axis=1, kind="stable")
            sorted_ = np.take_along_axis(spread, order, 1)
            again = np.zeros_like(fresh)
            np.put_along_axis(again, order[:, 1:], sorted_[:, 1:] == sorted_[:, :-1], 1)
            fresh &= ~again
            seen[each, spread] = True
            some = fresh.any(1)
            if not some.any():
                continue
            width = int(fresh.sum(1).max())
            pick = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
            spread = np.where(np.take_along_axis(fresh, pick, 1), np.take_along_axis(spread, pick, 1), -1)
            away = (2 - 2 * np.einsum("qcd,qd->qc", self.points[spread], queries)).astype("f4")
            away[spread < 0] = np.inf
            all_ids, all_near = np.concatenate([ids, spread], 1), np.concatenate([near, away], 1)
            all_waiting = np.concatenate([waiting, spread >= 0], 1)
            best = np.argpartition(all_near, beam - 1, axis=1)[:, :beam]
            ids, near, waiting = (np.take_along_axis(x, best, 1) for x in (all_ids, all_near, all_waiting))
            waiting &= np.isfinite(near)
            ids[~np.isfinite(near)] = -1
        order = np.argsort(near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


class ShardIndex:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: int = TOP, beam: int = SEARCH_BEAM):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        rows = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, point = np.unique(rows, return_index=True, return_inverse=True)
        self.vectors, self.top, self.beam = vectors[first], top, beam
        self.norms = np.sqrt(np.einsum("nd,nd->n", self.vectors, self.vectors))
        # Ids of each point, smallest first: a query needs no more than its own and `top` others.
        by_point = np.argsort(point, kind="stable")
        cuts = np.searchsorted(point[by_point], np.arange(len(first) + 1))
        self.ids = [ids[by_point[a : min(b, a + top + 1)]] for a, b in zip(cuts, cuts[1:])]
        unit = (self.vectors / self.norms[:, None]).astype("f4")
        self.graph = Graph(unit) if len(first) > beam else None

    def __call__(self, ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for a in range(0, len(ids), BLOCK):
            yield from self._search(ids[a : a + BLOCK], queries[a : a + BLOCK])

    def _search(self, ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        norms = np.sqrt(np.einsum("nd,nd->n", queries, queries))
        if self.graph is None:
            beams = np.tile(np.arange(len(self.vectors)), (len(ids), 1))
        else:
            unit = (queries / norms[:, None]).astype("f4")
            beams, _ = self.graph.beams(unit, self.graph.entries, self.beam)
        for own, query, norm, beam in zip(ids, queries, norms, beams, strict=True):
            points = beam[beam >= 0]
            scores = np.einsum("nd,d->n", self.vectors[points], query) / (self.norms[points] * norm)
            # A point has at least one id besides the query's own, but for the query's own point; points that tie with the last one needed count too.
            needed = min(len(points), self.top + 1)
            least = -np.partition(-scores, needed - 1)[needed - 1] if needed else 0.0
            rows = [(-s, int(v)) for p, s in zip(points.tolist(), scores.tolist()) if s >= least for v in self.ids[p] if v != own]
            rows = sorted(rows)[: self.top]
            yield np.full(len(rows), own), np.array([v for _, v in rows], "i8"), np.array([-s for s, _ in rows], "f8")


def nearest(vectors: DataFrame, top: int = TOP, every: int = EVERY, shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the `top` largest cosines found for each query, in double precision.

    Queries are the rows whose vec_id is divisible by `every`, candidates all rows but those of the query's own id, ties go to the smaller
    vec_id. Every usable row is in the index of one shard. Vectors null, empty, zero or with null or non-finite components take no part,
    nor do null ids. Rows that share a vec_id are one candidate with its best score. Columns besides vec_id and embedding are ignored.
    """
    usable = vector_shards.usable(vectors).where(F.exists("embedding", lambda x: x != 0))
    return vector_shards.search(usable, every, lambda i, v: ShardIndex(i, v, top, beam), shard_rows, top, "double")
