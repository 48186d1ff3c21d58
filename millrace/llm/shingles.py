"""Distinct word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5

_LOWER = np.arange(256, dtype="u1")
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_RANDOM = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out, step = np.ones(1, "u8"), base
            while len(out) < n:
                out, step = np.concatenate([out, out * np.uint64(step)]), step * step % (1 << 64)
            _powers[name] = out
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z in lower case, and the number of its text."""
    own = data[offsets[0] : offsets[-1]]
    if not len(own):
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    cuts = offsets - offsets[0]
    space = _SPACE[own]
    edge = np.zeros(len(own) + 1, bool)
    edge[cuts] = True
    begin = ~space
    begin[1:] &= space[:-1] | edge[1:-1]
    starts = np.flatnonzero(begin)
    end = ~space
    end[:-1] &= space[1:] | edge[1:-1]
    ends = np.flatnonzero(end) + 1
    up, down = _power_tables(len(own) + 1)
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_RANDOM[_LOWER[own]] * up[: len(own)], dtype="u8")])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype("u8"))
    return hashes, np.searchsorted(cuts, starts, "right") - 1


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted in each, and n + 1 offsets.

    A text of fewer words has one shingle, its whole sequence; one without words has none.
    """
    n = len(offsets) - 1
    hashes, of = word_hashes(data, offsets)
    first = np.searchsorted(of, np.arange(n + 1))
    counts = np.diff(first)
    total = np.zeros(max(0, len(hashes) - words + 1), "u8")
    for k in range(words):
        total = mixed(total + hashes[k : len(hashes) - words + 1 + k] + np.uint64(k + 1)) if len(total) else total
    good = of[: len(total)] == of[words - 1 :] if len(total) else np.zeros(0, bool)
    values, owner = total[good], of[: len(total)][good]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        whole = [xxhash.xxh64_intdigest(hashes[first[k] : first[k + 1]].tobytes()) for k in short]
        values, owner = np.concatenate([values, np.array(whole, "u8")]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, np.searchsorted(owner, np.arange(n + 1))
