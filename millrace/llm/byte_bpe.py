"""Byte-level BPE for many texts at once, in batched numpy merge rounds.

Texts are cut into words with array operations. The different words of a block lie side by side in one flat array of symbols. A round
looks up all neighbouring pairs by binary search in the sorted pairs of the vocabulary, finds each word's lowest rank and merges it
wherever it stands, in all words together; words without a known pair leave the array. Long words are merged together too, but by
rising rank, so that a round touches only the places that merge.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import arrow_text, shingles

BLOCK = 1 << 19  # bytes of text that are cut and merged together, about
LONG = 96  # bytes from which a word is merged by rising rank
NONE = np.int32(np.iinfo("i4").max)
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
APOSTROPHE, BLANK = 0x27, 0x20

# What the pattern of byte-level vocabularies cuts off after an apostrophe.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")

# A text may be cut before these blanks and marks when a plain letter stands before them: no word crosses the cut.
_SEAM = regex.compile(r"(?<=[A-Za-zÀ-ɏ一-龥])(?=[ \n、。，])")

_loaded: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pairs, ids and spelling of a byte-level BPE file, and the class of each character."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, before = said["model"], said.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model.get("type", "BPE") != "BPE" or said.get("normalizer") or not plain or odd:
            raise ValueError(f"{path}: a plain byte-level BPE is needed")
        added = said.get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens must match as they are")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}

        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], "i8") for k in (0, 1))
        made = np.array([ids[a + b] for a, b in pairs], "i4")
        rank_of = {m: r for r, m in reversed(list(enumerate(made.tolist())))}
        if any(rank_of.get(x, -1) >= r for r, p in enumerate(zip(left.tolist(), right.tolist())) for x in p):
            raise ValueError(f"{path}: a pair must come after the pairs that make its parts")
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype("i4")
        self.left, self.right, self.made = left.astype("i4"), right.astype("i4"), made
        self.byte_ids = np.array([ids[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])], "i4")

        self.special = {t["content"].encode(): t["id"] for t in added}
        spelled = {i: bytes(byte_of[c] for c in t) for t, i in ids.items() if all(c in byte_of for c in t)}
        spelled |= {i: t for t, i in self.special.items()}
        sizes = np.zeros(max(spelled, default=-1) + 1, "i8")
        sizes[list(spelled)] = [len(t) for t in spelled.values()]
        self.cuts = np.concatenate([[0], np.cumsum(sizes)])
        self.letters = np.frombuffer(b"".join(spelled[i] for i in sorted(spelled)), "u1")
        self.find = regex.compile(b"|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

        self.kinds = np.full(0x110000, UNKNOWN, "u1")
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def kinds_of(self, points: np.ndarray) -> np.ndarray:
        """Class of each code point. The file's own pattern is asked once for each character, as Unicode versions differ."""
        kinds = self.kinds[points]
        if (kinds == UNKNOWN).any():
            for c in np.unique(points[kinds == UNKNOWN]).tolist():
                beside = [len(self.cut(other + chr(c))) == 1 for other in "a1!"]
                self.kinds[c] = (LETTER, NUMBER, OTHER)[beside.index(True)] if any(beside) else SPACE
            kinds = self.kinds[points]
        return kinds

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, by binary search; NONE for unknown ones."""
        key = left.astype("i8") << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE) if len(self.keys) else np.full(len(key), NONE)


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def word_starts(points: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a word of the pattern starts at each character. first: whether a text starts there."""
    n = len(points)
    starts = first.copy()
    inner = ~first[1:]
    change = inner & (kinds[1:] != kinds[:-1])
    blank, space = points == BLANK, kinds == SPACE
    # A class that changes starts a word, unless a single blank before it belongs to the word.
    starts[1:] |= change & ~(blank[:-1] & ~space[1:])
    # The last white space before a word stands alone or leads the word.
    starts[:-1] |= space[:-1] & ~space[1:] & inner
    marks = np.flatnonzero(starts[:-1] & (points[:-1] == APOSTROPHE) & inner & (kinds[1:] == LETTER))
    if len(marks):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[marks + 1], np.where(np.append(first, [True, True])[marks + 2], 0, padded[marks + 2])
        size = np.where(np.isin(one, [ord(c) for c in SHORT_ENDINGS]), 1, 0)
        for a, b in LONG_ENDINGS:
            size[(one == ord(a)) & (two == ord(b))] = 2
        marks, size = marks[size > 0], size[size > 0]
        starts[marks + 1] = False
        after = marks + 1 + size
        starts[after[after < n]] = True
    return starts


def _merge_rounds(symbols: np.ndarray, word: np.ndarray, v: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merges words that lie side by side; symbols and words are given out as words end."""
    while len(symbols):
        ranks = np.full(len(symbols), NONE)
        ranks[:-1] = np.where(word[1:] == word[:-1], v.ranks(symbols[:-1], symbols[1:]), NONE)
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sizes = np.diff(np.append(heads, len(word)))
        least = np.repeat(np.minimum.reduceat(ranks, heads), sizes)
        done = least == NONE
        yield symbols[done], word[done]
        symbols, word, ranks, least = symbols[~done], word[~done], ranks[~done], least[~done]
        hits = every_second(np.flatnonzero(ranks == least))
        symbols[hits] = v.made[ranks[hits]]
        stay = np.ones(len(symbols), bool)
        stay[hits + 1] = False
        symbols, word = symbols[stay], word[stay]


def every_second(places: np.ndarray) -> np.ndarray:
    """Of places in a row, as a symbol that repeats makes them, the first, third and so on."""
    if not len(places):
        return places
    new = np.concatenate([[True], np.diff(places) != 1])
    begin = places[new][np.cumsum(new) - 1]
    return places[(places - begin) % 2 == 0]


def _merge_by_rank(symbols: np.ndarray, word: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merges long words side by side, rank by rank: a pair that a merge makes always has a higher rank."""
    n = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    edge = np.flatnonzero(word[1:] != word[:-1])
    after[edge], after[-1] = -1, -1
    before[edge + 1] = -1
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def add(places: np.ndarray) -> None:
        places = places[after[places] >= 0]
        ranks = v.ranks(symbols[places], symbols[after[places]])
        places, ranks = places[ranks < NONE], ranks[ranks < NONE]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        heads = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]])) if len(ranks) else []
        for rank, part in zip(ranks[heads].tolist() if len(ranks) else [], np.split(places, heads[1:]) if len(ranks) else []):
            if rank not in waiting:
                waiting[rank] = []
                heapq.heappush(queue, rank)
            waiting[rank].append(part)

    add(np.arange(n))
    while queue:
        rank = heapq.heappop(queue)
        places = np.unique(np.concatenate(waiting.pop(rank)))
        places = places[(symbols[places] == v.left[rank]) & (after[places] >= 0)]
        places = places[symbols[after[places]] == v.right[rank]]
        if v.left[rank] == v.right[rank] and len(places) > 1:
            linked = np.concatenate([[False], after[places[:-1]] == places[1:]])
            number = np.arange(len(places))
            places = places[(number - np.maximum.accumulate(np.where(linked, 0, number))) % 2 == 0]
        gone = after[places]
        symbols[places], symbols[gone] = v.made[rank], -1
        after[places] = after[gone]
        ahead = after[places] >= 0
        before[after[places[ahead]]] = places[ahead]
        add(np.unique(np.concatenate([places, before[places][before[places] >= 0]])))
    return symbols[symbols >= 0], word[symbols >= 0]


def _different(data: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words one of which stands for all equal ones, and for each word the place of its own among these."""
    up, down = shingles._power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(shingles._RANDOM[data] * up[: len(data)], dtype="u8")])
    hashes = shingles.mixed((sums[heads + sizes] - sums[heads]) * down[heads] + sizes.astype("u8"))
    _, one, of = np.unique(hashes, return_index=True, return_inverse=True)
    # Hashes only propose: a word that differs from the one it would share stands for itself.
    like = one[of]
    other = sizes != sizes[like]
    same = np.flatnonzero(~other & (like != np.arange(len(like))))
    if len(same):
        owner = np.repeat(same, sizes[same])
        upto = np.cumsum(sizes[same])
        within = np.arange(len(owner)) - np.repeat(upto - sizes[same], sizes[same])
        other[owner[data[heads[owner] + within] != data[heads[like[owner]] + within]]] = True
    alone = np.flatnonzero(other)
    of[alone] = len(one) + np.arange(len(alone))
    return np.concatenate([one, alone]), of


def _word_ids(data: np.ndarray, heads: np.ndarray, sizes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some words in a row, and n + 1 offsets."""
    word = np.repeat(np.arange(len(heads)), sizes)
    upto = np.cumsum(sizes)
    symbols = v.byte_ids[data[np.repeat(heads - (upto - sizes), sizes) + np.arange(len(word))]]
    long = np.repeat(sizes >= LONG, sizes)
    parts = list(_merge_rounds(symbols[~long], word[~long], v))
    if long.any():
        parts.append(_merge_by_rank(symbols[long], word[long], v))
    ids, owner = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (symbols, word)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.searchsorted(owner[order], np.arange(len(heads) + 1))


def encode_block(data: np.ndarray, offsets: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that lie side by side as valid UTF-8, and n + 1 offsets of the ids."""
    data, cuts = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    n = len(data)
    if not n:
        return np.zeros(0, "i4"), np.zeros(len(offsets), "i8")
    raw = data.tobytes()
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "u4")
    byte_of = np.flatnonzero(data & 0xC0 != 0x80)
    first_byte = np.zeros(n + 1, bool)
    first_byte[cuts] = True
    special = [(m.start(), m.end()) for m in v.find.finditer(raw)] if v.find else []
    special = [(a, b) for a, b in special if not first_byte[a + 1 : b].any()]
    for a, b in special:
        first_byte[[a, b]] = True
    begins = word_starts(points, first_byte[byte_of], v.kinds_of(points))
    starts = np.zeros(n, bool)
    starts[byte_of[begins]] = True
    for a, b in special:
        starts[a + 1 : b] = False
    heads = np.flatnonzero(starts)
    sizes = np.diff(np.append(heads, n))
    one, of = _different(data, heads, sizes)
    ids, at = _word_ids(data, heads[one], sizes[one], v)
    counts, begin = np.diff(at)[of], at[of]
    if special:
        where = np.searchsorted(heads, [a for a, _ in special])
        begin[where] = len(ids) + np.arange(len(where))
        counts[where] = 1
        ids = np.concatenate([ids, np.array([v.special[raw[a:b]] for a, b in special], ids.dtype)])
    upto = np.cumsum(counts)
    out = ids[np.repeat(begin - (upto - counts), counts) + np.arange(upto[-1])]
    return out, np.concatenate([[0], upto])[np.searchsorted(heads, cuts)]


def _parts(column: pa.Array, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Bytes and offsets of neighbouring texts, in blocks; the flag says that the block's only text goes on in the next one."""
    data, offsets = arrow_text.utf8_bytes(column)
    for a, b in arrow_text.blocks(offsets, block):
        if b - a > 1 or offsets[b] - offsets[a] <= block:
            yield data, offsets[a : b + 1], False
            continue
        text = data[offsets[a] : offsets[b]].tobytes().decode("utf-8")
        at = 0
        while at < len(text):
            seam = _SEAM.search(text, at + block)
            end = seam.start() if seam else len(text)
            part = np.frombuffer(text[at:end].encode(), "u1")
            yield part, np.array([0, len(part)]), end < len(text)
            at = end


def encode_column(column: pa.Array, v: Vocabulary, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a string column in a row, and n + 1 offsets; a null text is empty."""
    column = _valid(column)
    ids, counts, open_ = [np.zeros(0, "i4")], [], False
    for data, offsets, goes_on in _parts(column, block):
        found, at = encode_block(data, offsets, v)
        ids.append(found)
        each = np.diff(at).tolist()
        if open_:
            counts[-1] += each[0]
        else:
            counts.extend(each)
        open_ = goes_on
    return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.array(counts, "i8"))]).astype("i8")


def _valid(column: pa.Array) -> pa.Array:
    """The column with marks in place of bytes that are no UTF-8, as Python strings have them."""
    try:
        column.validate(full=True)
        return column
    except pa.ArrowInvalid:
        return pa.array([(x.as_py() or b"").decode("utf-8", "replace") for x in column.cast(pa.large_binary())], pa.large_string())


def decode_lists(ids: np.ndarray, offsets: np.ndarray, v: Vocabulary) -> list[str]:
    """Text of each list of ids. Ids that are not in the vocabulary are left out, bytes that are no UTF-8 are marked."""
    known = (ids >= 0) & (ids < len(v.cuts) - 1)
    safe = np.where(known, ids, 0)
    sizes = np.where(known, v.cuts[safe + 1] - v.cuts[safe], 0)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    out = v.letters[np.repeat(v.cuts[safe] - upto[:-1], sizes) + np.arange(upto[-1])].tobytes()
    ends = upto[offsets - offsets[0]].tolist()
    return [out[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null([]) if column.null_count else column
    offsets = np.array(column.offsets).astype("i8")
    return np.array(column.values)[offsets[0] : offsets[-1]], offsets


def encode_documents(docs: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """doc_id and ids (array of int) of every row: the whole text as the tokenizers library encodes it with the file, without added marks.

    docs: doc_id and text; other columns are ignored. A null text counts as empty and gives no ids. Texts that spell an added token have its id
    there. Rows that repeat are encoded each; a null id is kept; an empty table gives no rows. Texts are taken in blocks: a long text
    is cut where no word crosses the cut. path: a byte-level BPE file, the same on every machine.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets = encode_column(batch.column(1), vocabulary(path), block)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and text of every row of encode_documents(): the text that the ids spell, added tokens included. A null list is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = decode_lists(*_lists(batch.column(1)), vocabulary(path))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """doc_id, ids and text of every row in one pass: ids as unsigned 32-bit little-endian numbers, and the text that they spell.

    Rows are taken as by encode_documents() and decode_documents().
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            _, cuts = arrow_text.utf8_bytes(batch.column(1))
            for a, b in arrow_text.blocks(cuts, 4 * block):
                ids, offsets = encode_column(batch.column(1).slice(a, b - a), v, block)
                texts = decode_lists(ids, offsets, v)
                raw = ids.astype("<u4").tobytes()
                packed = [raw[4 * x : 4 * y] for x, y in zip(offsets.tolist(), offsets[1:].tolist())]
                columns = [batch.column(0).slice(a, b - a), pa.array(packed, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, ids binary, text string")


def digest(tripped: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of the result of round_trip()."""
    return tripped.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
