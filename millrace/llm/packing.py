"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. The rest of a document, after its full windows are cut
off, goes into the open window that it fills best; when it fits into none, the fullest is emitted. The
windows still open at the end of a task are packed anew, some tasks' together, largest piece first.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrow_text, tokens
from millrace.session import ARROW_ROWS_CONF, setting, settle, wide_rows

WINDOW = 2048
OPEN = 64
MERGED = 16
END = 1  # the id that closes each document
BATCH = 1 << 21  # bytes of text that are turned into ids at a time

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_FOUND = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "merge_group")])


class OpenWindows:
    """A fixed number of open windows; place() says where a piece goes, and which window is emitted for it."""

    def __init__(self, window: int, most: int, first_id: int):
        self.window, self.most, self.next_id = window, most, first_id
        self.free: list[tuple[int, int]] = []  # free space and window, in order

    def new_id(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, length: int) -> tuple[int, int, int | None]:
        """Window, offset in it, and the emitted window if one was."""
        emitted = None
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            space, window = self.free.pop(at)
        else:
            if len(self.free) >= self.most:
                emitted = self.free.pop(0)[1]
            space, window = self.window, self.new_id()
        if space > length:
            insort(self.free, (space - length, window))
        else:
            emitted = window
        return window, self.window - space, emitted


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, open_windows: int = OPEN, merged: int = MERGED) -> DataFrame:
    """Every id of every text in exactly one piece of a sequence of at most `window` ids.

    docs: doc_id and text; other columns are ignored. tokenizer: the path of a byte-level BPE file, the same on
    every machine. A null or empty text has one id, the closing one. Rows that repeat an id are documents of their own;
    a null id is kept. An empty table gives no pieces. Within a task documents are taken in the order read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        state = OpenWindows(window, open_windows, task << 32)
        pieces: dict[int, list[tuple]] = {}

        def rows(done: list[tuple], group: int | None) -> pa.RecordBatch:
            table = list(zip(*done, strict=True)) if done else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in table] + [pa.array([group] * len(done), pa.int64())], schema=_FOUND)

        for batch in batches:
            ids_of = batch.column(0).cast(pa.int64()).to_pylist()
            _, offsets = arrow_text.utf8_bytes(batch.column(1))
            for a, b in arrow_text.blocks(offsets, BATCH):
                done: list[tuple] = []
                ids, cuts = tokens.encode_all([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()], tokenizer)
                for k in range(b - a):
                    own = np.append(ids[cuts[k] : cuts[k + 1]], np.uint32(END)).astype("<u4")
                    total = len(own)
                    for start in range(0, total, window):
                        part = own[start : start + window]
                        piece = (ids_of[a + k], start, len(part), zlib.crc32(part.tobytes()), total)
                        if len(part) == window:
                            done.append((*piece, state.new_id(), 0))
                            continue
                        at, offset, emitted = state.place(len(part))
                        pieces.setdefault(at, []).append((*piece, at, offset))
                        if emitted is not None:
                            done += pieces.pop(emitted)
                yield rows(done, None)
        yield rows([p for _, w in state.free for p in pieces[w]], task // merged)

    def merge(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True], ignore_index=True)
        free: list[tuple[int, int]] = []
        first, used, placed = (1 << 62) + (int(rest["merge_group"].iloc[0]) << 32), 0, []
        for length in rest["length"].tolist():
            at = bisect_left(free, (length, -1))
            if at < len(free):
                space, own = free.pop(at)
            else:
                space, own = window, first + used
                used += 1
            placed.append((own, window - space))
            if space > length:
                insort(free, (space - length, own))
        rest["sequence_id"], rest["offset"] = zip(*placed, strict=True)
        return rest.drop(columns="merge_group")

    names = [f.name for f in _FOUND]
    with setting(docs.sparkSession, ARROW_ROWS_CONF, wide_rows(docs.sparkSession)):
        found = settle(docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names)), "packed")
    final = found.where(F.col("merge_group").isNull()).select(*names[:-1])
    rest = found.where(F.col("merge_group").isNotNull())
    return final.unionByName(rest.groupBy("merge_group").applyInPandas(merge, PIECE))
