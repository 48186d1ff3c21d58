"""Language identification by a byte convolutional network, trained in numpy.

A text is cut into windows of fixed length. Filters of several widths slide over a window's bytes, each filter keeps its largest
value, and a softmax layer gives the languages. The whole text counts: window probabilities are averaged by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrow_text

WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 256
PER_LANGUAGE = 500  # sampled texts of each language
CUTS = 3  # sampled windows of a text
EPOCHS = 12
BATCH = 64
RATE = 0.01
BLOCK = 1 << 18
TOGETHER = 64  # windows whose responses are held at a time
UNKNOWN = "und"


class ByteNet(NamedTuple):
    """languages, filter weights by width (width, 256, filters), their biases, and the softmax layer."""

    languages: tuple[str, ...]
    filters: tuple[np.ndarray, ...]
    biases: np.ndarray
    output: np.ndarray
    offset: np.ndarray


def untrained(languages: tuple[str, ...], seed: int = 1) -> ByteNet:
    random = np.random.default_rng(seed)
    filters = tuple(random.normal(0, 0.1, (w, 256, FILTERS)).astype("f4") for w in WIDTHS)
    total = FILTERS * len(WIDTHS)
    return ByteNet(languages, filters, np.zeros(total, "f4"), random.normal(0, 0.1, (total, len(languages))).astype("f4"), np.zeros(len(languages), "f4"))


def responses(net: ByteNet, windows: np.ndarray) -> list[np.ndarray]:
    """By width, what each filter gives at each place: arrays (window, place, filter)."""
    out = []
    for weights in net.filters:
        width = len(weights)
        places = windows.shape[1] - width + 1
        total = weights[0][windows[:, :places]]
        for k in range(1, width):
            total += weights[k][windows[:, k : k + places]]
        out.append(total)
    return out


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], epochs: int = EPOCHS, seed: int = 1) -> ByteNet:
    """Cross entropy by Adam; only the place of a filter's maximum passes a gradient back."""
    net = untrained(languages, seed)
    random = np.random.default_rng(seed)
    params = [*net.filters, net.biases, net.output, net.offset]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    share = np.bincount(labels, minlength=len(languages)) / max(1, len(labels))
    balance = (1 / np.maximum(share, 1e-9) / len(languages)).astype("f4")
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            x, y = windows[rows], labels[rows]
            places, peaks = [], []
            for r in responses(net, x):
                at = r.argmax(1)
                places.append(at)
                peaks.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
            raw = np.concatenate(peaks, 1) + net.biases
            hidden = np.maximum(raw, 0)
            error = softmax(hidden @ net.output + net.offset)
            error[np.arange(len(y)), y] -= 1
            error *= balance[y][:, None] / len(y)
            back = (error @ net.output.T) * (raw > 0)
            grads = []
            for k, weights in enumerate(net.filters):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                grad = np.zeros(weights.size, "f4")
                for j in range(len(weights)):
                    byte = x[np.arange(len(x))[:, None], places[k] + j].astype("i8")
                    np.add.at(grad, ((j * 256 + byte) * FILTERS + np.arange(FILTERS)).ravel(), own.ravel())
                grads.append(grad.reshape(weights.shape))
            grads += [back.sum(0), hidden.T @ error, error.sum(0)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


class PairTables:
    """The filters of a net with the sums for each pair of bytes worked out, to look up two bytes at a time."""

    def __init__(self, net: ByteNet):
        self.net = net
        two, three, four = net.filters

        def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a[:, None] + b[None, :]).reshape(65536, -1)

        self.first = np.concatenate([pairs(w[0], w[1]) for w in (two, three, four)], 1)
        self.third, self.second = three[2], pairs(four[2], four[3])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        peaks = np.concatenate([self.peaks(windows[k : k + TOGETHER]) for k in range(0, max(1, len(windows)), TOGETHER)])
        return softmax(np.maximum(peaks + self.net.biases, 0) @ self.net.output + self.net.offset)

    def peaks(self, windows: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each window."""
        pair = windows[:, :-1].astype("i4") << 8 | windows[:, 1:]
        places = windows.shape[1] - 3
        found = self.first[pair]
        f = FILTERS
        found[:, : places + 1, f : 2 * f] += self.third[windows[:, 2:]]
        found[:, :places, 2 * f :] += self.second[pair[:, 2:]]
        return np.concatenate([found[:, :, :f].max(1), found[:, : places + 1, f : 2 * f].max(1), found[:, :places, 2 * f :].max(1)], 1)


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts as rows of `window` bytes padded with zeros, the text of each row, and its bytes."""
    sizes = np.diff(offsets)
    each = -(-sizes // window)
    first = np.concatenate([[0], np.cumsum(each)])
    flat = np.zeros(int(first[-1]) * window, "u1")
    for k in np.flatnonzero(sizes):
        flat[first[k] * window : first[k] * window + sizes[k]] = data[offsets[k] : offsets[k + 1]]
    of = np.repeat(np.arange(len(sizes)), each)
    weight = np.minimum(window, sizes[of] - (np.arange(len(of)) - first[of]) * window)
    return flat.reshape(-1, window), of, weight


_tables: dict[int, PairTables] = {}


def predict(net: ByteNet, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probabilities (text, language) of whole texts; rows of empty texts are zero."""
    key = hash(net.output.tobytes())
    if key not in _tables:
        _tables.clear()
        _tables[key] = PairTables(net)
    total = np.zeros((len(offsets) - 1, len(net.languages)))
    for a, b in arrow_text.blocks(offsets, BLOCK):
        rows, of, weight = windows_of(data, offsets[a : b + 1])
        for k in range(0, len(rows), 512):
            part = _tables[key].probabilities(rows[k : k + 512])
            np.add.at(total, a + of[k : k + 512], part * weight[k : k + 512, None])
    return total / np.maximum(total.sum(1, keepdims=True), 1e-300)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """Language and a stretch of text for at most per_language texts of each language and CUTS stretches of a text.

    Only rows whose id is not held out, with a language. The ids are dealt by hash and the least hash of each deal is taken. The number of
    languages is taken to be small.
    """
    mixed = F.xxhash64("doc_id", F.lit("language"))
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2))
    least = usable.groupBy("lang", F.pmod(mixed, F.lit(per_language)).alias("deal")).agg(F.min(mixed).alias("least"))
    chosen = [r["least"] for r in least.collect()]
    if not chosen:
        return []
    size, long = F.length("text"), 2 * WINDOW
    starts = [F.lit(1), F.greatest(F.lit(1), (size / 2).cast("int")), F.greatest(F.lit(1), size - long)]
    cuts = F.array_distinct(F.array(*[F.substring(F.col("text"), s, F.lit(long)) for s in starts[:CUTS]]))
    picked = usable.where(mixed.isin(chosen)).select("lang", mixed.alias("mixed"), cuts.alias("cuts")).dropDuplicates(["mixed", "lang"])
    rows = sorted((r["lang"], r["mixed"], c) for r in picked.collect() for c in r["cuts"] if c)
    return [(lang, cut) for lang, _, cut in rows]


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> ByteNet | None:
    """A net trained on the sample; None if there is no labelled text."""
    rows = sample(docs, per_language)
    if not rows:
        return None
    languages = tuple(sorted({lang for lang, _ in rows}))
    windows, labels = np.zeros((len(rows), WINDOW), "u1"), np.zeros(len(rows), "i8")
    for k, (lang, cut) in enumerate(rows):
        piece = np.frombuffer(cut.encode()[:WINDOW], "u1")
        windows[k, : len(piece)], labels[k] = piece, languages.index(lang)
    return train(windows, labels, languages)


def identify(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, in the task that reads it.

    A null text, or one without letters, is `und` with score 0, and so is every text without a net. Rows that repeat stay rows; with
    a null id, held_out is false. Ties between languages go to the first by name. Columns besides doc_id and text are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spoken = np.array(batch.column(3).to_pylist(), bool)
            langs, scores = [UNKNOWN] * len(spoken), np.zeros(len(spoken))
            if net is not None:
                found = predict(net, *arrow_text.utf8_bytes(batch.column(1)))
                langs = [net.languages[k] if s else UNKNOWN for k, s in zip(found.argmax(1), spoken, strict=True)]
                scores = np.where(spoken, np.clip(found.max(1), 0, 1), 0.0)
            arrays = [batch.column(0), batch.column(2), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), spoken.alias("spoken"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def prediction(net: ByteNet | None, text: Column) -> Column:
    """Language and score of a text column, as a struct."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def each(column: pa.Array) -> pa.Array:
        spoken = np.array([t is not None and any(c.isalpha() for c in t) for t in column.to_pylist()], bool)
        langs, scores = [UNKNOWN] * len(spoken), np.zeros(len(spoken))
        if net is not None:
            found = predict(net, *arrow_text.utf8_bytes(column))
            langs = [net.languages[k] if s else UNKNOWN for k, s in zip(found.argmax(1), spoken, strict=True)]
            scores = np.where(spoken, np.clip(found.max(1), 0, 1), 0.0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang_pred", "score"])

    return each(text)
