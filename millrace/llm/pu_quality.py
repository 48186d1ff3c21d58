"""Quality scores by positive-unlabelled learning.

A linear model sees trusted positives and unlabelled web text, never negatives. With class prior p it minimises the non-negative risk
p E_P[loss(+)] + max(0, E_U[loss(-)] - p E_P[loss(-)]): the second term is an unbiased estimate of the risk on
negatives, and where it falls below zero the step goes against it. The logistic loss makes scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrow_text

POSITIVES, UNLABELLED = 3000, 6000  # sampled texts at most
EPOCHS, BATCH, RATE, DECAY = 40, 256, 0.01, 1e-4
FIRST_EPOCHS, CONFIDENCE = 10, 0.1  # of the model that the class prior comes from
THRESHOLD = 0.3
BLOCK = 1 << 19

MARKS = b".,;:!?'\"-_()[]{}<>/\\|#$%&*+=@~^`"
CLASSES = 6 + len(MARKS)  # small, large, digit, blank, line end, other, and each mark
STATISTICS = 8
FEATURES = CLASSES * CLASSES + STATISTICS


def _classes() -> np.ndarray:
    kinds = np.full(256, 5, "i8")
    kinds[128:] = 0  # letters of other alphabets, nearly always
    kinds[ord("a") : ord("z") + 1], kinds[ord("A") : ord("Z") + 1], kinds[ord("0") : ord("9") + 1] = 0, 1, 2
    kinds[[32, 9]], kinds[[10, 13]] = 3, 4
    for k, mark in enumerate(MARKS):
        kinds[mark] = 6 + k
    return kinds


KINDS = _classes()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of pairs of character classes, as square roots, and statistics of whole texts."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((n, FEATURES), "f4")
    own = data[offsets[0] : offsets[-1]]
    kinds, of = KINDS[own], np.repeat(np.arange(n), sizes)
    same = of[1:] == of[:-1]
    pairs = (of[:-1] * CLASSES + kinds[:-1]) * CLASSES + kinds[1:]
    counts = np.bincount(pairs[same], minlength=n * CLASSES * CLASSES).reshape(n, -1)
    out[:, :-STATISTICS] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    for k in np.flatnonzero(sizes):
        text = data[offsets[k] : offsets[k + 1]].tobytes()
        words, lines = text.split(), text.split(b"\n")
        lengths = [len(w) for w in words] or [0]
        out[k, -STATISTICS:] = (
            np.log1p(len(text)),
            np.log1p(len(words)),
            min(40.0, sum(lengths) / len(lengths)),
            min(40.0, max(lengths)),
            len(set(words)) / max(1, len(words)),
            len(set(lines)) / len(lines),
            np.log1p(len(text) / len(lines)),
            sum(line[-1:] in (b".", b"!", b"?") for line in lines) / len(lines),
        )
    return out


class Scorer(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 1) -> Scorer:
    """Non-negative unbiased risk by Adam over batches with both kinds of rows."""
    mean, scale = unlabelled.mean(0), np.maximum(unlabelled.std(0), 1e-3)
    p, u = (np.clip((x - mean) / scale, -8, 8).astype("f8") for x in (positive, unlabelled))
    random = np.random.default_rng(seed)
    w, b = np.zeros(p.shape[1]), 0.0
    m, v, step = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0

    def rate_of(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40)))

    for _ in range(epochs):
        order = random.permutation(len(u))
        for a in range(0, len(order), BATCH):
            xu, xp = u[order[a : a + BATCH]], p[random.integers(0, len(p), BATCH)]
            su, sp = rate_of(xu), rate_of(xp)
            negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            gain_p = (sp - 1) / len(sp) * prior  # of the loss of positives as positives
            less_u, less_p = su / len(su), -sp / len(sp) * prior  # of the risk on negatives
            if negative >= 0:
                gu, gp = less_u, gain_p + less_p
            else:
                gu, gp = -less_u, -less_p
            grad = np.append(gu @ xu + gp @ xp + DECAY * w, gu.sum() + gp.sum())
            step += 1
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w -= move[:-1]
            b -= move[-1]
    return Scorer(mean, scale, w, b, prior)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled rows, from these two kinds alone.

    A first model learns from every other row and scores the rest. Above the best of all cuts, unlabelled rows are taken to be positive, so the
    share of unlabelled rows above it over that of positives estimates the prior; cuts that few positives pass are uncertain and count for more.
    """
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    first = train(positive[::2], unlabelled[::2], 0.5, FIRST_EPOCHS)
    p, u = np.sort(first.score(positive[1::2])), np.sort(first.score(unlabelled[1::2]))
    above_p = 1 - np.searchsorted(p, p) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    doubt = sum(np.sqrt(np.log(4 / CONFIDENCE) / (2 * len(x))) for x in (p, u))
    best = np.argmin((above_u + doubt) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5))


def _dealt(rows: DataFrame, most: int, seed: str) -> list[int]:
    """At most `most` hashes of ids: the least of each deal."""
    mixed = F.xxhash64("doc_id", F.lit(seed))
    least = rows.groupBy(F.pmod(mixed, F.lit(most)).alias("deal")).agg(F.min(mixed).alias("least"))
    return sorted(r["least"] for r in least.collect())


def _features_of(docs: DataFrame, hashes: list[int], seed: str) -> np.ndarray:
    mixed = F.xxhash64("doc_id", F.lit(seed))
    chosen = docs.where(mixed.isin(hashes)).select(mixed.alias("mixed"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrow_text.utf8_bytes(batch.column(1))
            for a, b in arrow_text.blocks(offsets, BLOCK):
                rows = [r.tobytes() for r in features(data, offsets[a : b + 1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.binary())], names=["mixed", "x"])

    got = chosen.mapInArrow(run, "mixed long, x binary").dropDuplicates(["mixed"]).collect()
    rows = [bytes(r["x"]) for r in sorted(got, key=lambda r: r["mixed"])]
    return np.frombuffer(b"".join(rows), "f4").reshape(len(rows), FEATURES)


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Scorer | None:
    """A scorer from bounded samples: `positives` texts with quality 1 and `unlabelled` texts of any kind.

    Labels are used only of ids that are not held out, and only those of quality 1; rows with a null id or label are no labels. The class
    prior is estimated from the two samples. None if there is no positive text.
    """
    trusted = _dealt(labels.where((F.col("quality") == 1) & (remainder(F.col("doc_id")) != 0)), positives, "positive")
    if not trusted:
        return None
    web = _dealt(docs.where(remainder(F.col("doc_id")) != 0), unlabelled, "web")
    p, u = _features_of(docs, trusted, "positive"), _features_of(docs, web, "web")
    if not len(p) or not len(u):
        return None
    return train(p, u, class_prior(p, u))


def score_documents(docs: DataFrame, scorer: Scorer | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, in the task that reads it.

    A null text is empty and scored as such. Rows that repeat stay rows; with a null id, held_out is false. Without a scorer every score
    is 0.5. Columns besides doc_id and text are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrow_text.utf8_bytes(batch.column(1))
            parts = [np.zeros(0)]
            for a, b in arrow_text.blocks(offsets, BLOCK):
                parts.append(np.full(b - a, 0.5) if scorer is None else scorer.score(features(data, offsets[a : b + 1])))
            scores = np.concatenate(parts)
            arrays = [batch.column(0), batch.column(2), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype("i4"))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
