"""Event-time jobs on file or message-bus streams.

Builders take a streaming DataFrame and return one; they work the same on any
source. Runners start a query, let it take all that is there and wait for it.
Results go to folders, never to driver memory.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from millrace.session import scratch_dir


def stream_files(spark: SparkSession, path: str, schema: S.StructType | str, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder or glob as a stream. Files must land in event-time order if max_files is set."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermarks need zoned timestamps; the session time zone is UTC."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def tumbling_counts(stream: DataFrame, ts: str, key: str, length: str, delay: str) -> DataFrame:
    grouped = with_event_time(stream, ts, delay).groupBy(F.window(ts, length), key)
    return grouped.agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def sliding_sums(stream: DataFrame, ts: str, value: str, length: str, step: str, delay: str) -> DataFrame:
    grouped = with_event_time(stream, ts, delay).groupBy(F.window(ts, length, step))
    total = F.sum(F.col(value).cast("decimal(18,2)")).alias("total")
    return grouped.agg(total, F.count("*").alias("n")).select(F.col("window.start").alias("start"), "total", "n")


LOCAL_SESSIONS_CONF = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def sessions(stream: DataFrame, ts: str, key: str, gap: str, delay: str) -> DataFrame:
    """Runs of a key's events with no pause of `gap` or longer.

    With LOCAL_SESSIONS_CONF on, the rows of a key are merged to partial sessions in
    each task before the shuffle, so a busy key sends sessions and not rows.
    """
    grouped = with_event_time(stream, ts, delay).groupBy(F.session_window(ts, gap), key)
    return grouped.agg(F.count("*").alias("n")).select(
        F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n"
    )


def drop_duplicates(stream: DataFrame, ts: str, key: str, delay: str, lanes: int = 16) -> DataFrame:
    """One row per key within the watermark delay.

    The first step works on (key, time, lane), with lanes dealt at random, so that very many copies of one
    instant are thinned by many tasks before they meet. It drops only what has a copy of the same instant,
    so the second step sees each instant of a key and decides as it would alone.
    """
    dealt = with_event_time(stream, ts, delay).withColumn("_lane", F.floor(F.rand(17) * lanes).cast("int"))
    thinned = dealt.dropDuplicatesWithinWatermark([key, ts, "_lane"]).drop("_lane")
    return thinned.dropDuplicatesWithinWatermark([key])


class _Counter(StatefulProcessor):
    """Keeps one number per key and emits it whenever rows arrive."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self._count.get()
        n = (kept[0] if kept is not None else 0) + sum(int(part["n"].sum()) for part in rows)
        self._count.update((n,))
        yield pd.DataFrame({"key": [key[0]], "lane": [key[1]], "n": [n]})

    def close(self) -> None:
        pass


STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Arrow batches that a task counts at a time, and the count from which a key is busy.
HELD_BATCHES, BUSY = 64, 1000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n) of many batches at a time: states cost by the call, so a task sends counts and not rows."""

    def summed(held):
        counts = pa.Table.from_batches(held).group_by("key").aggregate([([], "count_all")])
        yield from counts.select(["key", "count_all"]).rename_columns(["key", "n"]).to_batches()

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if len(held) == HELD_BATCHES:
            yield from summed(held)
            held = []
    if held:
        yield from summed(held)


def running_counts(stream: DataFrame, key: str, lanes: int = 8) -> DataFrame:
    """Stateful count per key as (key, lane, n); the count of a key is the sum of its lanes' latest n.

    Tasks count before the shuffle. A key that a task has often is spread over `lanes` states, others have one, in lane 0.
    Needs the RocksDB state store.
    """
    key_type = stream.schema[key].dataType.simpleString()
    counted = stream.select(F.col(key).alias("key")).mapInArrow(_counted, f"key {key_type}, n long")
    lane = F.when(F.col("n") >= BUSY, F.floor(F.rand(23) * lanes)).otherwise(0).cast("int").alias("lane")
    return counted.select("key", lane, "n").groupBy("key", "lane").transformWithStateInPandas(
        statefulProcessor=_Counter(),
        outputStructType=f"key {key_type}, lane int, n long",
        outputMode="Update",
        timeMode="None",
    )


def latest(folder: DataFrame, keys: list[str], value: str, batch: str = "batch") -> DataFrame:
    """The value of the last batch per key, from a folder written by into_folder."""
    return folder.groupBy(*keys).agg(F.max_by(value, batch).alias(value))


def enrich(stream: DataFrame, static: DataFrame, on: str) -> DataFrame:
    """Stream joined to a static dimension, read anew in each batch."""
    return stream.join(static, on, "left")


def into_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink in which a batch owns its folder: running a batch again replaces it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


class _Progress(StreamingQueryListener):
    """Keeps three numbers of every batch, however many there are; a query itself remembers only its last ones."""

    def __init__(self) -> None:
        self.batches: dict[str, list[tuple[int, int, int]]] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.batches.setdefault(str(p.runId), []).append((p.batchId, p.numInputRows, late))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def of(self, query: StreamingQuery, seconds: float = 120) -> list[tuple[int, int, int]]:
        """The batches of a finished query. Its end is reported after all of its batches."""
        run = str(query.runId)
        with self._change:
            if not self._change.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"no report that query {run} has ended")
        return self.batches.get(run, [])


@dataclass(frozen=True)
class Run:
    """A finished query and (batch, input_rows, late_dropped) of each of its batches."""

    query: StreamingQuery
    batches: list[tuple[int, int, int]]


def run_available(result: DataFrame, path: str, checkpoint: str, mode: str = "append") -> Run:
    """Process what the source holds, write it below `path` and stop."""
    streams, progress = result.sparkSession.streams, _Progress()
    streams.addListener(progress)
    try:
        query = (
            result.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(into_folder(path))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return Run(query, progress.of(query))
    finally:
        streams.removeListener(progress)


def drain(
    spark: SparkSession, source: str, schema: S.StructType, ts: str, build: Callable[[DataFrame], DataFrame], label: str
) -> tuple[DataFrame, list[Run]]:
    """Run a windowed job over all files and close its last windows too.

    All files form one batch, so their order does not matter. Then one row with
    a far-future time lands in a second folder, the query is restarted from its
    checkpoint and emits every window that was still open. The marker row's own
    window never closes, so it is in no result.
    """
    out, checkpoint, marker = (scratch_dir(spark, f"{label}-{part}") for part in ("out", "checkpoint", "marker"))
    spark.createDataFrame([], schema).write.parquet(marker)

    def query() -> DataFrame:
        rows = stream_files(spark, source, schema)
        return build(rows.unionByName(stream_files(spark, marker, schema)))

    runs = [run_available(query(), out, checkpoint)]
    cells = [F.expr("TIMESTAMP_NTZ '2999-01-01 00:00:00'").cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    spark.range(1).select(*cells).write.mode("append").parquet(marker)
    runs.append(run_available(query(), out, checkpoint))
    return spark.read.parquet(out).drop("batch"), runs


def late_rows(spark: SparkSession, runs: list[Run]) -> DataFrame:
    """(run, batch, input_rows, late_dropped) of every batch of finished runs.

    Spark counts what its state operators drop: raw rows for duplicate removal,
    partial aggregates for windows.
    """
    rows = [(i, *batch) for i, run in enumerate(runs) for batch in run.batches]
    return spark.createDataFrame(rows, "run int, batch long, input_rows long, late_dropped long")
