"""Exact removal of long repeated byte strings, by sorted suffixes.

Only places that can begin a repeated string are sorted. Texts are cut at content-defined anchors, the least hashes of sliding
windows, which two equal strings have at the same places. A string is a candidate if each piece between anchors inside it occurs elsewhere.
Candidates are dealt by the least piece hash inside them, which equal strings share, and each bucket's suffixes are sorted
by deep-shallow sorting. A common prefix of the given length with a neighbour is a repeat. A bucket that is too large for a task is dealt anew by
all pieces inside its strings, and what is still crowded by whole strings; these smaller buckets are sorted alike.

Passages of more than 50 words that are too short to be removed stay. Those that the kept text of two documents has are shown beside it.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrow_text, deep_shallow, meeting, shingles
from millrace.session import settle

LENGTH = 400
GRAM = 16  # bytes that an anchor's hash covers
SPAN = 96  # places of which one is an anchor
ALIKE = 2 * SPAN + GRAM  # bytes of the shortest string that has a piece for sure, and of a passage at least
WORDS = 51  # words of a passage at least
UNIT = 1024  # candidate places in a row of the exchange at most
CROWDED = 1 << 16  # places of a bucket that are sorted together; a larger bucket is dealt anew by a longer key
COMPARED = 1 << 18  # places whose whole strings are compared at a time before they are dealt
BLOCK = 1 << 19
SORTED = 1 << 21  # bytes of units sorted together, about
_SEAM = 1 << 20  # bytes of a long text that are cut at a time
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Anchors:
    """Anchors and pieces of some texts; pieces lie between neighbouring anchors of one text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        own, cuts = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        self.length, self.own, self.cuts, n = length, own, cuts, len(own)
        up, self.down = shingles._power_tables(n + 1)
        down = self.down
        sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(shingles._RANDOM[own] * up[:n], dtype="u8")])
        self.sums = sums
        grams = max(0, n - GRAM + 1)
        hashes = shingles.mixed((sums[GRAM:] - sums[:-GRAM]) * down[:grams]) if grams else np.zeros(0, "u8")
        bits = max(1, int(n).bit_length())
        value = (hashes >> np.uint64(bits)) << np.uint64(bits) | np.arange(grams, dtype="u8")
        covered = 1
        while covered < SPAN and len(value):
            step = min(covered, SPAN - covered)
            value = np.minimum(value[:-step], value[step:]) if len(value) > step else value[:0]
            covered += step
        # least[i]: the anchor of the window of places i to i + SPAN - 1
        self.least = (value & np.uint64((1 << bits) - 1)).astype("i8")
        text = np.searchsorted(cuts, np.arange(len(self.least)), "right") - 1
        self.whole = np.arange(len(self.least)) + SPAN - 1 + GRAM <= cuts[text + 1] if len(self.least) else np.zeros(0, bool)
        self.places = np.unique(self.least[self.whole])
        of = np.searchsorted(cuts, self.places, "right") - 1
        self.piece = np.flatnonzero(of[1:] == of[:-1])  # anchors with a piece to the next one
        self.text = of[self.piece]
        a, b = self.places[self.piece], self.places[self.piece + 1] + GRAM
        self.hashes = shingles.mixed((sums[b] - sums[a]) * down[a] + (b - a).astype("u8"))

    @cached_property
    def _number(self) -> np.ndarray:
        """By place, the number of the anchor of the window that begins there."""
        return np.searchsorted(self.places, self.least)

    @cached_property
    def _ends(self) -> np.ndarray:
        """By place, the end of its text."""
        return np.repeat(self.cuts[1:], np.diff(self.cuts))

    def _strings(self, length: int, shared: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places whose string of `length` bytes has only shared pieces, and the numbers of its first and last anchor."""
        last = length - GRAM + 1 - SPAN
        rows = np.arange(max(0, len(self.least) - last))
        rows = rows[rows + length <= self._ends[: len(rows)]]
        from_, to = self._number[rows], self._number[rows + last]
        if shared is None:
            return rows, from_, to
        lone = np.zeros(len(self.places) + 1, "i8")
        lone[self.piece[~shared] + 1] = 1
        lone = np.cumsum(lone)  # lone pieces before each anchor
        good = lone[to] == lone[from_]
        return rows[good], from_[good], to[good]

    def alike(self, shared: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
        """Runs of places below `limit` whose string of ALIKE bytes has only shared pieces, if they may hold a passage: text, place, many."""
        rows = self._strings(ALIKE, shared)[0]
        rows = rows[rows < limit]
        if not len(rows):
            return []
        heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1] + 1]))
        first, last = rows[heads], rows[np.append(heads[1:], len(rows)) - 1]
        spaces = np.concatenate([[0], np.cumsum((self.own == 0x20) | (self.own >= 0x09) & (self.own <= 0x0D))])
        # A run that a stretch of a long text cuts off goes on in another stretch.
        keep = (spaces[last + ALIKE] - spaces[first] >= WORDS - 1) | (first == 0) | (last == limit - 1)
        first, last = first[keep], last[keep]
        text = np.searchsorted(self.cuts, first, "right") - 1
        return list(zip(text.tolist(), (first - self.cuts[text]).tolist(), (last + 1 - first).tolist(), strict=True))

    def candidates(self, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places whose string has only shared pieces, and a key of each: the least piece hash inside it.

        shared: by piece; without it all places count, and the key is a hash of all pieces inside a string.
        """
        rows, from_, to = self._strings(self.length, shared)
        number = len(self.places)
        if not len(rows):
            return rows, np.zeros(0, "u8")
        new = np.ones(len(rows), bool)
        new[1:] = (from_[1:] != from_[:-1]) | (to[1:] != to[:-1])
        runs = np.flatnonzero(new)
        if shared is None:
            a, b = self.places[from_[runs]], self.places[to[runs]] + GRAM
            keys = shingles.mixed((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype("u8"))
        else:
            hash_of = np.full(number + 1, np.iinfo("u8").max, "u8")
            hash_of[self.piece] = self.hashes
            keys = np.minimum.reduceat(hash_of, np.stack([from_[runs], to[runs]], 1).ravel())[::2]
        return rows, np.repeat(keys, np.diff(np.append(runs, len(rows))))


def _stretches(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, int, int]]:
    """First text, offsets, place of the first byte in its text, and places that belong here; a long text comes in overlapping stretches."""
    for a, b in arrow_text.blocks(offsets, BLOCK):
        size = int(offsets[b] - offsets[a])
        if b - a > 1 or size <= _SEAM:
            yield a, offsets[a : b + 1], 0, size
            continue
        for at in range(0, size, _SEAM):
            yield a, offsets[a] + np.array([at, min(size, at + _SEAM + length)]), at, _SEAM


def _pieces(length: int) -> meeting.Cut:
    def cut(batch: pa.RecordBatch, seen: set) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes | None]]:
        data, offsets = arrow_text.utf8_bytes(batch.column(1))
        names = np.array(batch.column(0))
        for a, cuts, _, _ in _stretches(offsets, length):
            found = Anchors(data, cuts, length)
            yield names[a : a + len(cuts) - 1], found.text.astype("u4"), found.hashes, None

    return cut


_UNIT_FIELDS = [("key", pa.int64()), ("row_key", pa.int64()), ("place", pa.int64()), ("many", pa.int64()), ("body", pa.binary())]
_UNITS = "key long, row_key long, place long, many long, body binary"


def _batch(units: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*units, strict=True), _UNIT_FIELDS, strict=True)], names=[n for n, _ in _UNIT_FIELDS])


class _Thinned:
    """Units of a task: of equal ones the first two go on with their bytes, the others are known to repeat and go on without.

    Known ones that follow each other in a text make one row, however many keys they have.
    """

    def __init__(self, length: int):
        self.length = length
        self.times: dict[bytes, int] = {}

    def units(self, found: Anchors, rows: np.ndarray, keys: np.ndarray, text: bytes, names: list[int], bases: list[int]) -> pa.RecordBatch:
        """Runs of neighbouring places with the same key. names and bases: row and place of the first byte, by text."""
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1] + 1) | (keys[1:] != keys[:-1])
        heads = np.flatnonzero(new)
        numbers = np.searchsorted(found.cuts, rows[heads], "right") - 1
        out, known = [], None
        for x, y, number in zip(heads.tolist(), np.append(heads[1:], len(rows)).tolist(), numbers.tolist(), strict=True):
            key, first = int(keys[x : x + 1].view("i8")[0]), int(found.cuts[number])
            for c in range(x, y, UNIT):
                start, many = int(rows[c]), min(UNIT, y - c)
                body = text[start : start + many - 1 + self.length]
                mark = hashlib.blake2b(body, digest_size=16, key=key.to_bytes(8, "little", signed=True)).digest()
                times = self.times[mark] = self.times.get(mark, 0) + 1
                row, place = names[number], bases[number] + start - first
                if times < 3:
                    out.append((key, row, place, many, body))
                elif known and known[:2] == (number, place):  # goes on where the last known one ends
                    out[known[2]] = (*out[known[2]][:3], out[known[2]][3] + many, None)
                    known = number, place + many, known[2]
                else:
                    out.append((key, row, place, many, None))
                    known = number, place + many, len(out) - 1
        return _batch(out)


def _units(length: int, buckets: int):
    """Units of neighbouring candidate places with the same key, and the bytes of their strings; without key and bytes, runs that may hold passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        thinned = _Thinned(length)
        for batch in batches:
            data, offsets = arrow_text.utf8_bytes(batch.column(1))
            names = batch.column(0).to_pylist()
            for a, cuts, base, limit in _stretches(offsets, length):
                flags = batch.column(2).slice(a, len(cuts) - 1)
                if flags.null_count == len(flags):
                    continue
                found = Anchors(data, cuts, length)
                shared = np.isin(meeting.identity(found.hashes, buckets), np.array(flags.flatten(), "i8"))
                if alike := found.alike(shared, limit):
                    yield _batch([(None, names[a + number], base + place, many, None) for number, place, many in alike])
                rows, least = found.candidates(shared)
                rows, least = rows[rows < limit], least[rows < limit]
                if len(rows):
                    yield thinned.units(found, rows, least, data[cuts[0] : cuts[-1]].tobytes(), names[a : a + len(cuts) - 1], [base] * (len(cuts) - 1))

    return run


def _cut_anew(length: int):
    """Units cut again by a key of all pieces inside their strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        thinned = _Thinned(length)
        for batch in batches:
            names, places, bodies = (batch.column(k).to_pylist() for k in (1, 2, 4))
            ends = np.cumsum([0] + [len(b) for b in bodies])
            for a, b in arrow_text.blocks(ends, BLOCK):
                text = b"".join(bodies[a:b])
                found = Anchors(np.frombuffer(text, "u1"), ends[a : b + 1] - ends[a], length)
                rows, keys = found.candidates()
                yield thinned.units(found, rows, keys, text, names[a:b], places[a:b])

    return run


_STRINGS = "kind int, string long, row_key long, unit long, place long"
_KNOWN, _LONE, _AGAIN = range(3)


def _strings(length: int):
    """Whole strings of units, compared within the task: kind, hash, row_key, place of the unit and place.

    Places whose string the task has twice are known to repeat. Of each different string one place goes on, to meet those of other tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def compared() -> pa.RecordBatch:
            nonlocal held, size
            text = b"".join(body for *_, body in held)
            many = np.array([m for _, _, m, _ in held])
            begins = np.cumsum([0] + [len(body) for *_, body in held])[:-1]
            of = np.repeat(np.arange(len(held)), many)
            within = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            at = begins[of] + within
            up, down = shingles._power_tables(len(text) + 1)
            sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(shingles._RANDOM[np.frombuffer(text, "u1")] * up[: len(text)], dtype="u8")])
            hashes = shingles.mixed((sums[at + length] - sums[at]) * down[at])
            order = np.argsort(hashes, kind="stable")
            heads = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
            kind, sent = np.full(len(of), -1, "i4"), []
            for a, b in zip(heads.tolist(), np.append(heads[1:], len(order)).tolist()):
                members = order[a:b]
                kind[members[0]] = _LONE
                if b - a == 1:
                    continue
                different: dict[bytes, int] = {}
                for m in members.tolist():
                    own = text[at[m] : at[m] + length]
                    if own in different:
                        kind[m], kind[different[own]] = _KNOWN, _AGAIN
                    else:
                        different[own], kind[m] = m, _LONE
            again = np.flatnonzero(kind == _AGAIN)
            # A place that stands for others of its task is known to repeat too.
            sent = np.concatenate([np.arange(len(of)), again])
            kinds = np.concatenate([kind, np.full(len(again), _KNOWN, "i4")])
            rows, units = np.array([r for r, *_ in held]), np.array([p for _, p, *_ in held])
            columns = [kinds, hashes[sent].view("i8"), rows[of[sent]], units[of[sent]], units[of[sent]] + within[sent]]
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "string", "row_key", "unit", "place"])

        for batch in batches:
            for _, row, place, many, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((row, place, many, body))
                size += many
                if size >= COMPARED:
                    yield compared()
        if held:
            yield compared()

    return run


def _singled(length: int):
    """Units of one place each for the wanted strings of a unit, keyed by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, place, body, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(w["string"], row, w["place"], 1, body[w["place"] - place : w["place"] - place + length]) for w in wanted]
            if out:
                yield _batch(out)

    return run


def _repeats(length: int):
    """Repeated places of units that come sorted by key: row_key, place, many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, list[tuple[int, int, int]]]] = []
        bodies: dict[bytes, list[tuple[int, int, int]]] = {}
        at, size, out = None, 0, []

        def close() -> None:
            """End of a key: equal units repeat as a whole; others are to be sorted with all of the key, or with themselves."""
            nonlocal bodies, size
            for rows in bodies.values():
                if len(rows) > 1:
                    out.extend(rows)
            if any(len(rows) == 1 for rows in bodies.values()):
                for body, rows in bodies.items():
                    held.append((at, body, rows))
                    size += len(body)
            bodies = {}

        def sort() -> pa.RecordBatch:
            nonlocal held, size, out
            if held:
                many = np.array([rows[0][2] for _, _, rows in held])
                sizes = np.array([len(body) for _, body, _ in held])
                keys = np.cumsum([0] + [int(x[0] != y[0]) for x, y in zip(held[1:], held)])
                begins = np.cumsum(sizes) - sizes
                which = np.repeat(np.arange(len(held)), many)
                within = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                hit = deep_shallow.repeated(
                    b"".join(body for _, body, _ in held), begins[which] + within, (begins + sizes)[which], within == 0, keys[which], length
                )
                edge = np.flatnonzero(np.diff(np.concatenate([[0], (hit * (which + 1)), [0]])))
                for x, y in zip(edge, edge[1:]):
                    if hit[x] and len(held[which[x]][2]) == 1:
                        row, place, _ = held[which[x]][2][0]
                        out.append((row, place + int(within[x]), int(y - x)))
            batch = _ranges(out)
            held, size, out = [], 0, []
            return batch

        for batch in batches:
            for key, row, place, many, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    close()
                    at = key
                    if size >= SORTED or len(out) >= 1 << 16:
                        yield sort()
                bodies.setdefault(body, []).append((row, place, many))
        close()
        yield sort()

    return run


def _ranges(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row_key", "place", "many"])


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")


_PLACES = "row_key long, place long, many long"


def _crowded(units: DataFrame, most: int, label: str) -> DataFrame:
    """Keys of more places than a task shall sort together."""
    return settle(units.groupBy("key").agg(F.sum("many").alias("n")).where(F.col("n") > most).select("key"), label)


def _sorted(units: DataFrame, length: int) -> DataFrame:
    return units.repartition("key").sortWithinPartitions("key").mapInArrow(_repeats(length), _PLACES)


def _by_whole_strings(units: DataFrame, length: int) -> DataFrame:
    """Repeated places of units, dealt by hashes of whole strings.

    A task compares its own strings first, so that each goes on once, however often the task has it. Hashes say which strings may have an equal one
    elsewhere; only these go on with their bytes, to be sorted.
    """
    strings = settle(units.mapInArrow(_strings(length), _STRINGS), "suffix-strings")
    known = strings.where(F.col("kind") == _KNOWN).select("row_key", "place", F.lit(1).cast("long").alias("many"))
    each = strings.where(F.col("kind") != _KNOWN)
    twice = each.groupBy("string").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == _LONE).alias("lone")).where("n > 1 and lone > 0").select("string")
    wanted = each.join(twice, "string").groupBy("row_key", F.col("unit").alias("place")).agg(F.collect_set(F.struct("place", "string")).alias("wanted"))
    singled = units.select("row_key", "place", "body").join(wanted, ["row_key", "place"]).mapInArrow(_singled(length), _UNITS)
    return known.unionByName(_sorted(singled, length))


def candidate_units(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Units of candidate places, and without a key the runs of places that may hold a passage. docs: keyed()."""
    if length < 2 * SPAN + GRAM:
        raise ValueError(f"repeated strings have at least {2 * SPAN + GRAM} bytes")
    texts = docs.select("row_key", "text")
    entries, _ = meeting.shared(texts, _pieces(length), "suffix-pieces")
    flags = entries.groupBy(F.col("owner").alias("row_key")).agg(F.collect_set("key").alias("pieces"))
    flagged = texts.join(flags, "row_key").select("row_key", "text", "pieces")
    return settle(flagged.mapInArrow(_units(length, meeting.bucket_count(docs.sparkSession)), _UNITS), "suffix-units")


def repeated_places(units: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """row_key, place, many: runs of places at which a string of `length` bytes begins that also begins elsewhere. units: candidate_units().

    A bucket with more than `crowded` places is dealt anew by all pieces inside its strings, and one that still has more by whole strings.
    """
    units = units.where(F.col("key").isNotNull())
    found = units.where(F.col("body").isNull()).select("row_key", "place", "many")
    units = units.where(F.col("body").isNotNull())
    heavy = _crowded(units, crowded, "suffix-crowded")
    if heavy.isEmpty():
        return found.unionByName(_sorted(units, length))
    found = found.unionByName(_sorted(units.join(heavy, "key", "left_anti"), length))
    anew = units.join(heavy, "key", "left_semi").select("key", "row_key", "place", "many", "body").mapInArrow(_cut_anew(length), _UNITS)
    anew = settle(anew, "suffix-anew")
    found = found.unionByName(anew.where(F.col("body").isNull()).select("row_key", "place", "many"))
    anew = anew.where(F.col("body").isNotNull())
    heavy = _crowded(anew, crowded, "suffix-crowded")
    if heavy.isEmpty():
        return found.unionByName(_sorted(anew, length))
    found = found.unionByName(_sorted(anew.join(heavy, "key", "left_anti"), length))
    still = anew.join(heavy, "key", "left_semi").select("key", "row_key", "place", "many", "body")
    return found.unionByName(_by_whole_strings(still, length))


_LEFT = "row_key long, stretches array<struct<start:long,end:long>>"


def _left(length: int):
    """What is kept of runs of alike places, if a passage has room there. Of a row: row_key, runs of alike places and of repeated ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, left = [], []
            for row, alike, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                gone = _merged([(r["place"], r["place"] + r["many"] - 1 + length) for r in runs or ()])
                ends, found = [b for _, b in gone], []
                for start, end in _merged([(r["place"], r["place"] + r["many"]) for r in alike]):
                    end += ALIKE - 1
                    for a, b in gone[bisect.bisect_right(ends, start) :]:
                        if a >= end:
                            break
                        if a - start >= ALIKE:
                            found.append({"start": start, "end": a})
                        start = max(start, b)
                    if end - start >= ALIKE:
                        found.append({"start": start, "end": end})
                if found:
                    rows.append(row)
                    left.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(left, _SPANS)], names=["row_key", "stretches"])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_WINDOWS = "row_key long, start long, end long, mark binary, first boolean"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of WORDS whole words inside the stretches of a text: where, a hash, and whether the text has it for the first time."""
    for batch in batches:
        data, offsets = arrow_text.utf8_bytes(batch.column(1))
        out = []
        for k, (row, stretches) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            text, seen = data[offsets[k] : offsets[k + 1]].tobytes(), set()
            for s in stretches:
                words = [m.span() for m in _WORD.finditer(text, s["start"], s["end"])]
                if words and words[0][0] and not text[words[0][0] - 1 : words[0][0]].isspace():
                    words = words[1:]
                if words and words[-1][1] < len(text) and not text[words[-1][1] : words[-1][1] + 1].isspace():
                    words = words[:-1]
                for (a, _), (_, b) in zip(words, words[WORDS - 1 :]):
                    if b - a >= ALIKE:
                        mark = hashlib.blake2b(text[a:b], digest_size=16).digest()
                        out.append((row, a, b, mark, mark not in seen))
                        seen.add(mark)
        columns = zip(*out, strict=True) if out else ([],) * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["row_key", "start", "end", "mark", "first"])


def left_passages(docs: DataFrame, units: DataFrame, held: DataFrame, length: int = LENGTH) -> DataFrame:
    """row_key and strings: start and end of each string of WORDS words that the kept text of another document has too.

    A string has ALIKE bytes at least, whole words of the text, and no removed byte. held: repeated places of `length` bytes by row_key.
    """
    alike = units.where(F.col("key").isNull()).groupBy("row_key").agg(F.collect_list(F.struct("place", "many")).alias("alike"))
    stretches = settle(alike.join(held, "row_key", "left").select("row_key", "alike", "runs").mapInArrow(_left(length), _LEFT), "suffix-left")
    # The stretches grow with the corpus, so they are dealt out at every size instead of being sent whole to every task.
    texts = docs.select("row_key", "text").join(stretches.hint("merge"), "row_key")
    windows = settle(texts.mapInArrow(_windows, _WINDOWS), "suffix-windows")
    twice = windows.groupBy("mark").agg(F.count_if("first").alias("n")).where("n > 1").select("mark")
    return windows.join(twice, "mark").groupBy("row_key").agg(F.collect_list(F.struct("start", "end")).alias("strings"))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, joined where they meet or overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """doc_id, n_bytes, spans (start and end of each maximal removed run), kept (the remaining bytes) and passages of every row.

    passages: start and end, in the text, of each maximal run of kept strings of 51 words that another document's kept text has too. They stay.

    Each byte goes that is covered by a string of `length` bytes which also begins anywhere else, in the same text or another; all copies go.
    Texts count as UTF-8 bytes, a null text as empty, and no string crosses texts. Rows that repeat are documents of their own: their
    long strings repeat. A null id is kept. Columns besides doc_id and text are ignored.
    """
    rows = keyed(docs)
    units = candidate_units(rows, length)
    runs = settle(repeated_places(units, length, crowded), "suffix-repeats")
    held = runs.groupBy("row_key").agg(F.collect_list(F.struct("place", "many")).alias("runs"))
    left = left_passages(rows, units, held, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrow_text.utf8_bytes(batch.column(1))
            found, kept = [], []
            passages = [[{"start": a, "end": b} for a, b in _merged([(s["start"], s["end"]) for s in strings or ()])] for strings in batch.column(3).to_pylist()]
            for k, runs in enumerate(batch.column(2).to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                gone = np.zeros(len(own) + 2, "i4")
                for run in runs or ():
                    gone[run["place"] + 1] += 1
                    gone[run["place"] + run["many"] - 1 + length + 1] -= 1
                covered = np.cumsum(gone) > 0
                edges = np.flatnonzero(covered[1:] != covered[:-1])
                found.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(own[~covered[1:-1]].tobytes() if runs else own.tobytes())
            columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array(found, _SPANS), pa.array(kept, pa.binary()), pa.array(passages, _SPANS)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept", "passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = rows.join(held, "row_key", "left").join(left, "row_key", "left").select("doc_id", "text", "runs", "strings")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, passages array<struct<start:long,end:long>>")


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, kept_text, n_left and n_repeated of the result of remove_repeats().

    kept_text: the remaining bytes as text; a character of which only some bytes remain becomes U+FFFD there. Hash and length are those of the bytes.
    n_left: kept bytes in passages of more than 50 words that another document's kept text has too. n_repeated: n_removed and n_left together.
    """
    gone, left = (F.aggregate(c, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]) for c in ("spans", "passages"))
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text")
    return removed.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("long").alias("n_kept"), text, left.alias("n_left"), (gone + left).alias("n_repeated"))
