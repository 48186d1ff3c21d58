"""Keys that occur at least twice in a corpus, with their owners, in one shuffle.

A task sorts its keys. Those it has twice are known to be shared, whatever the others have, and only a mark of each goes on; single
ones go with their owner to the key's bucket, where they meet the others. So a key comes to its bucket a few times for each task at most,
however often it occurs. Keys travel in sorted blocks, as their 48 low bits: the bucket stands for the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ARROW_ROWS_CONF, setting, settle, wide_rows

FLUSH = 1 << 20  # entries sorted at a time
PASSED = 1 << 16  # known entries handed on in a batch
BUCKETS = 8  # for each shuffle partition
MARK = 0xFFFFFFFF
LOW = np.uint64((1 << 48) - 1)

SINGLE, SHARED, NAMES, SIDE = range(4)
_SENT = "bucket long, kind int, flush long, keys binary, owners binary"
_FOUND = "kind int, flush long, owner long, key long, side binary"

Cut = Callable[[pa.RecordBatch, set], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes | None]]]


def _planes(values: np.ndarray, kept: int) -> bytes:
    """The low bytes of numbers, byte by byte: sorted numbers compress well in this order."""
    return values.astype("<u8").view("u1").reshape(-1, 8)[:, :kept].T.tobytes()


def _numbers(planes: bytes, kept: int) -> np.ndarray:
    found = np.frombuffer(planes, "u1").reshape(kept, -1)
    wide = np.zeros((found.shape[1], 8), "u1")
    wide[:, :kept] = found.T
    return wide.view("<u8").ravel()


def bucket_count(spark: SparkSession) -> int:
    return min(1 << 16, BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype("i8")


def identity(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Keys as shared() returns them: the bucket instead of the high bits."""
    return ((keys & LOW) | bucket_of(keys, buckets).astype("u8") << np.uint64(48)).view("i8")


def shared(rows: DataFrame, cut: Cut, label: str) -> tuple[DataFrame, DataFrame]:
    """(owner, key) of each entry whose key has another entry, and the side blocks.

    cut turns a batch of `rows` into blocks: names of owners (64-bit), owner number and key (unsigned 64-bit) of each entry, and bytes that
    are handed through. It is also given a set that lives as long as the task.
    """
    buckets = bucket_count(rows.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, flushed, rows_out = TaskContext.get().partitionId(), 0, 0
        names: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        seen: set = set()
        size = count = 0

        def row(kind: int, bucket: int, keys: bytes, owners: bytes) -> tuple:
            return bucket, kind, (task << 32) + flushed, keys, owners

        def flush() -> pa.RecordBatch:
            nonlocal flushed, names, owners, keys, size, count
            k, o = np.concatenate(keys), np.concatenate(owners)
            keys, owners = [], []
            order = np.argsort(k)
            k, o = k[order], o[order]
            same = np.concatenate([[False], k[1:] == k[:-1], [False]])
            twice = same[1:] | same[:-1]
            out = [row(NAMES, task * 31 + flushed, np.concatenate(names).astype("<i8").tobytes(), b"")]
            if twice.any():
                out.append(row(SHARED, task * 17 + flushed, k[twice].astype("<u8").tobytes(), o[twice].astype("<u4").tobytes()))
            marks = k[twice & ~same[:-1]]
            one = np.concatenate([k[~twice], marks])
            of = np.concatenate([o[~twice], np.full(len(marks), MARK, "u4")])
            del k, o, same, twice
            order = np.argsort(one)
            one, of = one[order], of[order]
            homes = bucket_of(one, buckets)
            starts = np.flatnonzero(np.concatenate([[True], homes[1:] != homes[:-1]])) if len(one) else np.zeros(0, "i8")
            for a, b in zip(starts, np.append(starts[1:], len(one))):
                out.append(row(SINGLE, int(homes[a]), _planes(one[a:b], 6), _planes(of[a:b], 4)))
            flushed, names, owners, keys, size, count = flushed + 1, [], [], [], 0, 0
            return _batch(out)

        for batch in batches:
            for name, owner, key, side in cut(batch, seen):
                if side is not None:
                    yield _batch([row(SIDE, task * 13 + rows_out, side, b"")])
                    rows_out += 1
                if len(key):
                    names.append(name)
                    owners.append(owner.astype("u4") + np.uint32(count))
                    keys.append(key)
                    size, count = size + len(key), count + len(name)
                    if size >= FLUSH:
                        yield flush()
        if size:
            yield flush()
        # A worker outlives its task; what it does not use goes back to the machine, where the executor needs it.
        seen.clear()
        pa.default_memory_pool().release_unused()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def settle_bucket() -> pa.RecordBatch:
            flushes = np.repeat([f for f, _, _ in held], [len(k) for _, k, _ in held]).astype("i8")
            keys, owners = np.concatenate([k for _, k, _ in held]), np.concatenate([o for _, _, o in held])
            order = np.argsort(keys)
            keys, owners, flushes = keys[order], owners[order], flushes[order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            marked = owners == MARK
            total = np.add.reduceat(1 + marked.astype("i8"), starts)
            keep = (np.repeat(total, np.diff(np.append(starts, len(keys)))) >= 2) & ~marked
            key = keys[keep] | np.uint64(at) << np.uint64(48)
            return _found(SHARED, flushes[keep], owners[keep], key)

        for batch in batches:
            for bucket, kind, flush, keys, owners in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == SINGLE:
                    if held and bucket != at:
                        yield settle_bucket()
                        held = []
                    at = bucket
                    held.append((flush, _numbers(keys, 6), _numbers(owners, 4)))
                elif kind == SHARED:
                    key, owner = np.frombuffer(keys, "<u8"), np.frombuffer(owners, "<u4")
                    for a in range(0, len(key), PASSED):
                        part = identity(key[a : a + PASSED], buckets)
                        yield _found(SHARED, np.full(len(part), flush), owner[a : a + PASSED], part)
                elif kind == NAMES:
                    names = np.frombuffer(keys, "<i8")
                    yield _found(NAMES, np.full(len(names), flush), np.arange(len(names)), names)
                else:
                    yield _found(SIDE, np.zeros(1, "i8"), np.zeros(1, "i8"), np.zeros(1, "i8"), keys)
        if held:
            yield settle_bucket()
        held = []
        pa.default_memory_pool().release_unused()

    sent = rows.mapInArrow(send, _SENT)
    met = sent.repartition("bucket").sortWithinPartitions("kind", "bucket").mapInArrow(meet, _FOUND)
    with setting(rows.sparkSession, ARROW_ROWS_CONF, wide_rows(rows.sparkSession)):
        kept = settle(met, label)
    names = kept.where(F.col("kind") == NAMES).select("flush", "owner", F.col("key").alias("name"))
    entries = kept.where(F.col("kind") == SHARED).select("flush", "owner", "key")
    sides = kept.where(F.col("kind") == SIDE).select("side")
    return entries.join(names, ["flush", "owner"]).select(F.col("name").alias("owner"), "key"), sides


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["bucket", "kind", "flush", "keys", "owners"])


def _found(kind: int, flush: np.ndarray, owner: np.ndarray, key: np.ndarray, side: bytes | None = None) -> pa.RecordBatch:
    n = len(flush)
    arrays = [
        pa.array(np.full(n, kind, "i4")),
        pa.array(flush.astype("i8")),
        pa.array(owner.astype("i8")),
        pa.array(key.astype("u8").view("i8") if key.dtype.kind == "u" else key.astype("i8")),
        pa.nulls(n, pa.binary()) if side is None else pa.array([side] * n, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "flush", "owner", "key", "side"])
