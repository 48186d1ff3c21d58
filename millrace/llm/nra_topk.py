"""Exact top-k search by no-random-access aggregation.

A shard holds one list for each component, sorted by value. A block of queries reads all lists in step, each query from the better end of each list.
What is read of a candidate bounds its score from below and above: an unread part is at least the list's last value and at most its next one. A query
stops when few enough candidates can still reach its k-th lower bound; those get their final scores as whole numbers. Outsiders cannot qualify.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import vector_shards

TOP, EVERY, SCALE = 10, 100, 1024
SHARD_ROWS = 16384
DEPTHS = (0.5, 0.75, 0.875)  # shares of the lists after which queries may stop; then all is read
RESOLVED = 32  # candidates for each wanted one whose scores are resolved when reading stops
BLOCK = 128  # queries that read together
ROUNDING = 1e-5  # of the sum of a query's weights, by which bounds in single precision may be off
_WHOLE = float(1 << 62)
_LARGEST = 10**38 - 1  # the largest number of 38 digits


class SortedLists:
    """Vectors of whole numbers, given as doubles, as sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: int = TOP):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows, self.top = ids[order], np.ascontiguousarray(vectors[order], "f8"), top
        self.most = float(np.abs(self.rows).max(initial=0))
        self.unit = self.rows / (self.most or 1.0)
        places = np.argsort(self.unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, places, 0)
        self.place = np.empty(places.shape, "i4")
        np.put_along_axis(self.place, places, np.arange(len(places), dtype="i4")[:, None], 0)
        self.read: dict[float, tuple] = {}

    def _read(self, share: float) -> tuple[np.ndarray, ...]:
        """What is read of each candidate down to a share of the lists, beyond the last value and the next one, from above and from below."""
        if share not in self.read:
            n = len(self.ids)
            depth = min(n - 1, int(n * share))
            last = np.concatenate([self.sorted[0], self.sorted[-1]])
            ahead = np.concatenate([self.sorted[n - 1 - depth], self.sorted[depth]])
            seen = np.concatenate([self.place >= n - depth, self.place < depth], 1)
            both = np.concatenate([self.unit, self.unit], 1)
            self.read[share] = *(np.where(seen, both - edge, 0).astype("f4") for edge in (last, ahead)), last, ahead
        return self.read[share]

    def candidates(self, queries: np.ndarray, own: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each query, by number, rows among which the best are; own: ids that take no part."""
        n, others = len(self.ids), self.ids[:, None] != own[None, :]
        weights = queries / np.maximum(np.abs(queries).max(1, initial=0), 1e-300)[:, None]
        sides = np.concatenate([np.maximum(weights, 0), np.minimum(weights, 0)], 1)
        slack = ROUNDING * np.abs(weights).sum(1)
        waiting = np.arange(len(queries))
        if n <= self.top * RESOLVED:
            yield from ((k, np.flatnonzero(others[:, k])) for k in waiting)
            return
        for share in DEPTHS:
            if not len(waiting):
                return
            above_last, above_ahead, last, ahead = self._read(share)
            turned = sides[waiting].T.astype("f4")
            low = np.where(others[:, waiting], above_last @ turned + (sides[waiting] @ last).astype("f4"), -np.inf)
            least = np.partition(low, n - self.top, axis=0)[n - self.top] - slack[waiting]
            high = above_ahead @ turned + (sides[waiting] @ ahead).astype("f4")
            left = (high >= (least - slack[waiting]).astype("f4")) & others[:, waiting]
            few = left.sum(0) <= self.top * RESOLVED
            yield from ((int(waiting[k]), np.flatnonzero(left[:, k])) for k in np.flatnonzero(few))
            waiting = waiting[~few]
        if len(waiting):
            scores = np.where(others[:, waiting], self.unit @ weights[waiting].T, -np.inf)
            least = np.partition(scores, n - self.top, axis=0)[n - self.top] - slack[waiting]
            for k, number in enumerate(waiting.tolist()):
                yield number, np.flatnonzero((scores[:, k] >= least[k]) & others[:, number])

    def scores(self, rows: np.ndarray, query: np.ndarray) -> list[int]:
        """Exact inner products."""
        if self.most * float(np.abs(query).max(initial=0)) * max(1, len(query)) < _WHOLE and self.most < _WHOLE:
            return (self.rows[rows].astype("i8") @ query.astype("i8")).tolist()
        whole = [int(x) for x in query.tolist()]
        return [sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in self.rows[rows].tolist()]

    def __call__(self, ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        for a in range(0, len(ids), BLOCK):
            own, block = ids[a : a + BLOCK], queries[a : a + BLOCK]
            for k, rows in self.candidates(block, own):
                found = sorted(zip((-s for s in self.scores(rows, block[k])), self.ids[rows].tolist(), strict=True))[: self.top]
                scores = [max(-_LARGEST, min(_LARGEST, -s)) for s, _ in found]
                yield np.full(len(found), own[k]), np.array([v for _, v in found], "i8"), scores


def _scaled(scale: int, top: int):
    """Index of a shard whose components, and those of its queries, become floor(scale * x)."""

    def build(ids: np.ndarray, vectors: np.ndarray):
        lists = SortedLists(ids, np.floor(vectors * scale), top)
        return lambda own, queries: lists(own, np.floor(queries * scale))

    return build


def top_products(vectors: DataFrame, top: int = TOP, every: int = EVERY, scale: int = SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the `top` largest inner products of vectors of floor(scale * x).

    Queries are the rows whose vec_id is divisible by `every`, candidates all rows but those of the query's own id, ties go to the smaller
    vec_id. Vectors null, empty or with components that are null or not finite, before or after scaling, take no part, nor do null ids; a zero vector
    does. Rows that share a vec_id are one candidate with its best score. Scores are exact whole numbers; they are ranked by up to 38
    digits, and one that is no long is null in the result. Columns besides vec_id and embedding are ignored.
    """
    usable = vector_shards.usable(vectors).where(F.forall("embedding", lambda x: F.abs(x * scale) < float("inf")))
    found = vector_shards.search(usable, every, _scaled(scale, top), shard_rows, top, "decimal(38,0)")
    return found.withColumn("score", F.col("score").try_cast("long"))


def top_products_sql(top: int = TOP, every: int = EVERY, scale: int = SCALE) -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
 FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {top}"""
