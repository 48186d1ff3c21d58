"""Searches of a stated query set against all vectors, shard by shard.

Vectors are dealt over shards of bounded size by hash. Blocks of queries go to every shard. Each shard is a task of its own,
which streams the blocks past the shard's index. Nothing is broadcast, and a task holds one shard and one block of queries.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BLOBS = "shard int, width int, kind int, ids binary, vectors binary"
Index = Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding as doubles, without null, empty and non-finite vectors and null ids."""
    whole = F.col("embedding").cast("array<double>")
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)


def search(vectors: DataFrame, every: int, build: Callable[[np.ndarray, np.ndarray], Index], shard_rows: int, top: int, score: str) -> DataFrame:
    """query_id, rank, vec_id, score: the best `top` candidates of each query over all shards, ties to the smaller vec_id.

    vectors: vec_id and embedding, usable. Queries are the rows whose id is divisible by `every`. build(ids, vectors) indexes a shard;
    the index, called with ids and vectors of queries, gives query ids, candidate ids and scores, as doubles or whole numbers of up to 38 digits
    as `score` says. Only vectors as long as
    the query are candidates. Rows that share a vec_id are one candidate, with its best score.
    """
    shards = max(1, math.ceil(vectors.count() / shard_rows))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            widths = np.diff(np.frombuffer(lists.buffers()[1], "i4")[lists.offset : lists.offset + len(lists) + 1])
            ids, homes = np.array(batch.column(0)), np.array(batch.column(2))
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                rows = np.array(lists.take(pa.array(own)).flatten()).reshape(-1, width)
                asked = ids[own] % every == 0
                of_shard = np.argsort(homes[own], kind="stable")
                cuts = np.searchsorted(homes[own][of_shard], np.arange(shards + 1))
                for shard, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                    for kind, picked in ((0, of_shard[a:b]), (1, np.flatnonzero(asked))):
                        if len(picked):
                            values = [[shard], [int(width)], [kind], [ids[own[picked]].tobytes()], [rows[picked].tobytes()]]
                            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _TYPES, strict=True)], names=_NAMES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            for shard, width, kind, ids, rows in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                own, matrix = np.frombuffer(ids, "i8"), np.frombuffer(rows, "f8").reshape(-1, width)
                if at != (shard, width):
                    at, held, index = (shard, width), [], None
                if kind == 0:
                    held.append((own, matrix))
                elif held:
                    if index is None:
                        index = build(*(np.concatenate(part) for part in zip(*held, strict=True)))
                    for q, v, s in index(own, matrix):
                        arrays = [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64() if score == "double" else pa.decimal128(38, 0))]
                        yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    homed = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    dealt = homed.select("vec_id", "embedding", "shard").mapInArrow(deal, _BLOBS)
    sorted_ = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "width", "kind")
    found = sorted_.mapInArrow(scan, f"query_id long, vec_id long, score {score}")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


_NAMES = ["shard", "width", "kind", "ids", "vectors"]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
