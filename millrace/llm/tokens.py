"""Token ids of a public byte-level BPE vocabulary for many texts at once.

The vocabulary file names the merges, and a pattern cuts a text into pieces that are merged one by one,
so a piece has the same ids wherever it stands. Texts of simple characters are cut with array
operations and their pieces are looked up in a table by hash, one slot for each; all others go through the tokenizer's own pattern.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import regex
import tiktoken

# The pieces of the public vocabulary's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SIMPLE = 0x250  # code points below this are classified by table
LONGEST = 1 << 18  # characters cut with array operations at a time
SLOT_BITS = 20  # a worker remembers at most this power of two of pieces
POOL = 1 << 22  # and at most so many ids of them

SPACE, LETTER, NUMBER, OTHER = range(4)
_state: dict = {}


def byte_alphabet() -> dict[str, int]:
    """The byte of each character in which byte-level vocabularies spell their tokens."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load(path: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizer file, with its ids as merge ranks."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if all(c in alphabet for c in token) and not token.startswith("<|")}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _prepared(path: str) -> dict:
    if _state.get("path") != path:
        kinds = np.full(SIMPLE + 1, OTHER, "u1")
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
            kinds[[c for c in range(SIMPLE) if regex.match(pattern, chr(c))]] = kind
        random = np.random.default_rng(7).integers(1, 1 << 63, SIMPLE + 1, dtype="u8")
        _state.clear()
        _state.update(path=path, encoding=load(path), kinds=kinds, random=random * np.uint64(2) + np.uint64(1), powers=_powers(LONGEST + 1))
        _forget(_state)
    return _state


def _forget(state: dict) -> None:
    slots = 1 << SLOT_BITS
    state.update(hash=np.zeros(slots, "u8"), place=np.zeros(slots, "i4"), size=np.zeros(slots, "i4"), pool=np.zeros(POOL, "u4"), used=0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        out, step = np.ones(1, "u8"), b
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(step)])
            step = step * step % (1 << 64)
        both.append(out)
    return both[0], both[1]


def encode_all(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row as unsigned 32-bit numbers, and n + 1 offsets."""
    state = _prepared(path)
    parts: list[np.ndarray] = []
    lengths = np.zeros(len(texts), "i8")
    simple: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal simple, size
        if simple:
            ids, counts = _encode_simple([texts[i] for i in simple], state)
            cuts = np.concatenate([[0], np.cumsum(counts)])
            for k, i in enumerate(simple):
                parts[i] = ids[cuts[k] : cuts[k + 1]]
                lengths[i] = counts[k]
        simple, size = [], 0

    for i, text in enumerate(texts):
        parts.append(np.zeros(0, "u4"))
        if not text:
            continue
        if "'" in text or len(text) > LONGEST or not _is_simple(text):
            parts[i] = np.array(state["encoding"].encode_ordinary(text), "u4")
            lengths[i] = len(parts[i])
            continue
        if size + len(text) > LONGEST:
            flush()
        simple.append(i)
        size += len(text)
    flush()
    return (np.concatenate(parts) if parts else np.zeros(0, "u4")), np.concatenate([[0], np.cumsum(lengths)])


def _is_simple(text: str) -> bool:
    return text.isascii() or max(text) < chr(SIMPLE)


def _encode_simple(texts: list[str], state: dict) -> tuple[np.ndarray, np.ndarray]:
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), "u4")
    n = len(points)
    kinds = state["kinds"][points]
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    first = np.zeros(n + 1, bool)
    first[begins] = True
    space, blank = kinds == SPACE, points == 32
    starts = first[:n].copy()
    after = ~first[1:n]  # a character with one before it in the same text
    change = after & (kinds[1:] != kinds[:-1])
    # Words begin where the class changes, unless a single blank before them belongs to them.
    starts[1:] |= change & ~(blank[:-1] & ~space[1:])
    # The last white space before a word stands alone or leads it.
    starts[:-1] |= space[:-1] & ~space[1:] & after
    heads = np.flatnonzero(starts)
    ends = np.append(heads[1:], n)
    powers, inverse = state["powers"]
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(state["random"][points] * powers[:n], dtype="u8")])
    hashes = (sums[ends] - sums[heads]) * inverse[heads]
    places, each = _look_up(joined, heads, ends, hashes, state)
    upto = np.cumsum(each)
    out = state["pool"][np.repeat(places - (upto - each), each) + np.arange(upto[-1])]
    before = np.concatenate([[0], upto])
    return out, np.diff(before[np.searchsorted(heads, begins)])


def _look_up(joined: str, heads: np.ndarray, ends: np.ndarray, hashes: np.ndarray, state: dict) -> tuple[np.ndarray, np.ndarray]:
    """Where the ids of each piece begin in the pool, and how many there are."""
    slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype("i8")
    known = state["hash"][slots] == hashes
    places, each = state["place"][slots], state["size"][slots]
    if known.all():
        return places, each
    new = np.flatnonzero(~known)
    _, where, inverse_of = np.unique(hashes[new], return_index=True, return_inverse=True)
    single = state["encoding"]._core_bpe.encode_single_piece
    ids = [single(joined[a:b].encode()) for a, b in zip(heads[new[where]].tolist(), ends[new[where]].tolist(), strict=True)]
    sizes = np.fromiter(map(len, ids), "i4", len(ids))
    flat = np.fromiter(chain.from_iterable(ids), "u4", int(sizes.sum()))
    if state["used"] + len(flat) > len(state["pool"]):
        _forget(state)
        return _look_up(joined, heads, ends, hashes, state)
    begin = state["used"] + np.cumsum(sizes, dtype="i4") - sizes
    state["pool"][state["used"] : state["used"] + len(flat)] = flat
    state["used"] += len(flat)
    at = slots[new[where]]
    state["hash"][at], state["place"][at], state["size"][at] = hashes[new[where]], begin, sizes
    places[new], each[new] = begin[inverse_of], sizes[inverse_of]
    return places, each
