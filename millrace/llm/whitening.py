"""Whitening of vectors by the singular vectors of their centred rows.

Each task reduces blocks of centred rows to an upper triangle by QR; triangles are stacked and reduced again, some tasks' together, until one
is left, whose squares are n times the covariance. Its singular values and vectors come by way of the bidiagonal form. Centred rows are exact whole
numbers over n, so that a large common offset costs no digits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import bidiagonal
from millrace.session import settle

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 52)  # scaled entries from which a double has no fraction
STACKED = 8  # triangles that are reduced together
BLOCK = 4096  # rows whose triangle is found at a time
_HALF = 20  # whole numbers are added up as two halves, the lower one of so many bits
_LONG = (1 << 63) - 1


@dataclass
class Whitening:
    """n rows with whole-number sums in each dimension; directions are columns, each over the root of its eigenvalue."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    directions: np.ndarray
    trace: float

    def deviations(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S of each entry as exact whole numbers, and whether a row has an entry for which they leave 62 bits."""
        base = np.array([s // self.n for s in self.sums], "i8")
        rest = np.array([s % self.n for s in self.sums], "i8")
        apart = rows - base
        far = (np.abs(apart) > (1 << 62) // self.n - 1).any(1)
        return np.where(far[:, None], 0, apart) * self.n - rest, far

    def centred(self, rows: np.ndarray) -> np.ndarray:
        exact, far = self.deviations(rows)
        out = exact / self.n
        if far.any():
            out[far] = [[(int(x) * self.n - s) / self.n for x, s in zip(row, self.sums, strict=True)] for row in rows[far].tolist()]
        return out

    def squares(self, rows: np.ndarray) -> list[int | None]:
        """Exact sum of squares of n * x - S in each row; None where it is no long."""
        exact, far = self.deviations(rows)
        about = (exact.astype("f8") ** 2).sum(1)
        out: list[int | None] = (np.where((about < 2.0**62)[:, None], exact, 0) ** 2).sum(1).tolist()
        for k in np.flatnonzero(far | (about >= 2.0**62)).tolist():
            whole = sum((int(x) * self.n - s) ** 2 for x, s in zip(rows[k].tolist(), self.sums, strict=True))
            out[k] = whole if whole <= _LONG else None
        return out


def whole_numbers(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and x, an array of floor(scale * entry) + offset as long.

    Vectors that are null, empty or hold null or non-finite entries are left out, and those with an entry beyond 2**52 in size after scaling, which are no
    whole numbers that a double tells apart. Of vectors of different lengths, those of the most frequent one stay, of equally frequent ones the longest.
    """
    entries = F.col("embedding").cast("array<double>")
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < LARGEST))
    rows = vectors.where(entries.isNotNull() & (F.size(entries) > 0) & usable).select("vec_id", F.transform(entries, lambda c: F.floor(c * scale) + offset).alias("x"))
    rows = settle(rows, "whitening-rows")
    width = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    return rows.where(F.size("x") == width[0]["width"]) if width else rows


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1)


def _added(rows: DataFrame, value: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, float]:
    """Sums by place of the arrays that `value` makes of batches of the array column; as many as one array has places."""
    number = pa.int64() if kind == "long" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array([value(_matrix(batch.column(0))).ravel()], pa.list_(number))], names=["parts"])

    parts = rows.mapInArrow(run, f"parts array<{kind}>").select(F.posexplode("parts").alias("place", "part"))
    total = F.sum(F.col("part").cast("decimal(38,0)") if kind == "long" else F.col("part"))
    return {r["place"]: r["total"] for r in parts.groupBy("place").agg(total.alias("total")).collect()}


def _halves(rows: np.ndarray) -> np.ndarray:
    """Number of rows and, by dimension, sums of the upper and the lower part of each entry."""
    return np.concatenate([[len(rows)], (rows >> _HALF).sum(0), (rows & (1 << _HALF) - 1).sum(0)])


def _triangle(parts: list[np.ndarray]) -> np.ndarray:
    stacked = np.concatenate(parts)
    r = np.linalg.qr(stacked, mode="r")
    return np.concatenate([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])


def _triangles(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    r = None
    for block in blocks:
        r = _triangle([block] if r is None else [r, block])
    if r is not None:
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["triangle"])


def triangle(rows: DataFrame, model: Whitening) -> np.ndarray:
    """The triangle R of all centred rows: R'R is n times their covariance. rows: array column of whole numbers."""
    width = len(model.sums)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                whole = _matrix(batch.column(0)) if len(batch) else np.zeros((0, width), "i8")
                yield from (model.centred(whole[a : a + BLOCK]) for a in range(0, len(whole), BLOCK))

        yield from _triangles(blocks())

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _triangles(np.frombuffer(t, "f8").reshape(width, width) for batch in batches for t in batch.column(0).to_pylist())

    found = settle(rows.mapInArrow(first, "triangle binary"), "whitening-triangles")
    while (count := found.count()) > 1:
        found = settle(found.repartition(math.ceil(count / STACKED)).mapInArrow(again, "triangle binary"), "whitening-triangles")
    return np.frombuffer(found.collect()[0]["triangle"], "f8").reshape(width, width)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Directions of the largest eigenvalues of the covariance of x, divisor n; None without rows. rows: whole_numbers().

    Directions in which the rows do not vary (eigenvalues that are rounding errors of the largest) cannot be whitened and are left out.
    """
    x = rows.select("x")
    parts = _added(x, _halves, "long")
    if not parts:
        return None
    width = (len(parts) - 1) // 2
    sums = [(int(parts[1 + d]) << _HALF) + int(parts[1 + width + d]) for d in range(width)]
    model = Whitening(int(parts[0]), sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    r = triangle(x, model)
    values, vectors = bidiagonal.right_singular(r)
    varied = values > (8 * max(width, 8) * bidiagonal.EPS) ** 2 * values[0] if len(values) else np.zeros(0, bool)
    k = min(components, int(varied.sum()))
    model.eigenvalues = values[:k] / model.n
    model.directions = vectors[:, :k] / np.sqrt(model.eigenvalues)
    model.trace = float((r * r).sum()) / model.n
    return model


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (exact, null where it is no long) and whitened, an array by component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            whole = _matrix(batch.column(1))
            out = model.centred(whole) @ model.directions
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.squares(whole), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the covariance of all whitened rows minus the identity; rows are centred before they are multiplied."""
    k, w = len(model.eigenvalues), whitened.select("whitened")
    means = _added(w, lambda rows: rows.sum(0), "double")
    mean = np.array([means[i] for i in range(k)]) / model.n

    def products(rows: np.ndarray) -> np.ndarray:
        own = rows - mean
        return own.T @ own

    found = _added(w, products, "double")
    return float(np.abs(np.array([found[i] for i in range(k * k)]).reshape(k, k) / model.n - np.eye(k)).max())


SCHEMA = "vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_rows(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """SCHEMA: one row for each usable vector and component, components numbered from 1 by falling eigenvalue.

    vectors: vec_id and embedding; other columns are ignored, null ids are kept, rows that repeat count each. Which vectors are usable says
    whole_numbers(). Only directions that vary have a component, so that equal vectors, a single one or an empty table give no rows.
    """
    rows = whole_numbers(vectors, scale, offset)
    model = fit(rows, components)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], SCHEMA.format(kind=vectors.schema["vec_id"].dataType.simpleString()))
    white = settle(whiten(rows, model), "whitening-white")
    error = identity_error(white, model)
    explained = F.array(*[F.lit(float(e) / model.trace) for e in model.eigenvalues])
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
