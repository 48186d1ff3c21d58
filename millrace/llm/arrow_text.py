"""Text columns of Arrow batches as byte and code-point arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as one byte array, and n + 1 offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], "i8")[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, "u1") if data else np.zeros(0, "u1")), offsets


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about `limit` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def rows_of(values: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) for f in schema], schema=schema)
