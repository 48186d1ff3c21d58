"""Tracking of message-bus offsets on a stream: gaps, late arrivals, repeats and losses of each partition as rows."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "topic string, partition int, kind string, first long, last long, times long"
_STATE = "next long, missing string"
_RANGES = "topic string, partition int, first long, last long, seen timestamp"


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring offsets; the second and later copies of an offset are runs of their own."""
    for batch in batches:
        rows = batch.to_pandas()
        out = []
        for (topic, partition), part in rows.groupby(["topic", "partition"], sort=False):
            offsets, times = np.unique(part["offset"].to_numpy(), return_counts=True)
            newest = part["seen"].max()
            while len(offsets):
                new = np.flatnonzero(np.concatenate([[True], np.diff(offsets) > 1, [True]]))
                out += [(topic, partition, int(offsets[a]), int(offsets[b - 1]), newest) for a, b in zip(new, new[1:])]
                offsets, times = offsets[times > 1], times[times > 1] - 1
        if out:
            columns = list(zip(*out, strict=True))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), batch.schema.field("seen").type]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["topic", "partition", "first", "last", "seen"])


def covered(ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Stretches (first, last, times) in order over which equally many of the ranges lie."""
    edges: dict[int, int] = {}
    for a, b in ranges:
        edges[a] = edges.get(a, 0) + 1
        edges[b + 1] = edges.get(b + 1, 0) - 1
    out, depth, at = [], 0, None
    for place in sorted(edges):
        if depth:
            out.append((at, place - 1, depth))
        depth += edges[place]
        at = place
    return joined(out)


def joined(rows: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Neighbouring stretches that are covered equally often as one."""
    out: list[tuple[int, int, int]] = []
    for a, b, times in rows:
        if out and out[-1][1] + 1 == a and out[-1][2] == times:
            out[-1] = (out[-1][0], b, times)
        else:
            out.append((a, b, times))
    return out


def advanced(following: int | None, missing: list[list[int]], ranges: list[tuple[int, int]], now: int) -> tuple[int, list[list[int]], list[tuple]]:
    """The next expected offset, missing ranges (first, last, noticed at) and the rows (kind, first, last, times) after a batch of ranges."""
    stretches = covered(ranges)
    following = stretches[0][0] if following is None else following
    limit = following
    late, repeats, gaps, left, opened = [], [], [], [], []
    # Stretches and missing ranges both lie in order and apart, so one walk along the two meets every overlap.
    rest = deque(missing)
    for a, b, times in stretches:
        old_end = min(b, limit - 1)
        if a <= old_end:
            at = a
            while rest and rest[0][1] < a:
                left.append(rest.popleft())
            while rest and rest[0][0] <= old_end:
                first, last, noticed = rest.popleft()
                low, high = max(first, a), min(last, old_end)
                late.append((low, high, 1))
                if at < low:
                    repeats.append((at, low - 1, times))
                if times > 1:
                    repeats.append((low, high, times - 1))
                at = high + 1
                if first < low:
                    left.append([first, low - 1, noticed])
                if last > high:
                    rest.appendleft([high + 1, last, noticed])
            if at <= old_end:
                repeats.append((at, old_end, times))
        if b >= following:
            start = max(a, following)
            if start > following:
                gaps.append((following, start - 1, 1))
                opened.append([following, start - 1, now])
            if times > 1:
                repeats.append((start, b, times - 1))
            following = b + 1
    missing = [*left, *rest, *opened]
    rows = [("gap", *r) for r in joined(sorted(gaps))] + [("late", *r) for r in joined(sorted(late))] + [("repeat", *r) for r in joined(sorted(repeats))]
    return following, missing, rows


def track_offsets(records: DataFrame, patience: str, delay: str = "0 seconds") -> DataFrame:
    """SCHEMA rows of a stream of message-bus records (topic, partition, offset, timestamp), in append mode.

    gap: offsets that a batch jumps over; late: offsets of a gap that come after all; repeat: offsets that came before, with how often they
    come again; lost: what is still missing when the watermark is `patience` past the time of the batch that jumped. Offsets that arrive after they are
    lost count as repeats. Order within a batch does not matter. The first batch of a partition sets where it begins. State is the next
    offset and the open gaps of each partition; tasks send runs of offsets, so a busy partition sends few rows.
    """
    wait = int(pd.Timedelta(patience).total_seconds() * 1000)
    runs = records.select("topic", "partition", "offset", F.col("timestamp").cast("timestamp").alias("seen")).mapInArrow(_compressed, _RANGES)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, text = state.get if state.exists else (None, "[]")
        missing = json.loads(text)
        rows: list[tuple] = []
        if state.hasTimedOut:
            limit = state.getCurrentWatermarkMs()
            gone = [m for m in missing if m[2] + wait <= limit]
            missing = [m for m in missing if m[2] + wait > limit]
            rows = [("lost", a, b, 1) for a, b, _ in sorted(gone)]
        else:
            frame = pd.concat(list(parts))
            now = int(frame["seen"].max().timestamp() * 1000)
            following, missing, rows = advanced(following, missing, list(zip(frame["first"].tolist(), frame["last"].tolist())), now)
        state.update((following, json.dumps(missing)))
        if missing:
            # A timer must lie after the watermark.
            state.setTimeoutTimestamp(max(min(m[2] for m in missing) + wait, state.getCurrentWatermarkMs() + 1))
        if rows:
            kinds, firsts, lasts, times = zip(*rows, strict=True)
            yield pd.DataFrame({"topic": key[0], "partition": np.int32(key[1]), "kind": kinds, "first": firsts, "last": lasts, "times": times})

    return runs.withWatermark("seen", delay).groupBy("topic", "partition").applyInPandasWithState(step, SCHEMA, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
