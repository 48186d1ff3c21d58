"""Deep-shallow sorting of suffixes.

Suffixes are sorted by multikey quicksort, eight bytes at a time, to a shallow depth. Groups that still agree have long
common prefixes: they go into blind tries, which compare each suffix with one leaf only. A group that is another one moved on by a byte has its
order, and common prefixes shorter by one, so only the first group of such a chain is put into a trie.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32


class BlindTrie:
    """Suffixes of a buffer, each up to an end of its own, by the bytes in which they first differ.

    A node is [depth, children by next byte, a leaf]; -1 is the next byte of a suffix that ends. Leaves are lists of equal suffixes.
    """

    def __init__(self, buffer: bytes, known: int = 0):
        self.buffer, self.known = buffer, known  # bytes that all suffixes have in common
        self.root: list | None = None

    def common(self, a: int, b: int, limit: int) -> int:
        """Length of the common prefix, at most limit."""
        buffer, low, high = self.buffer, min(self.known, limit), limit
        if buffer[a + low : a + high] == buffer[b + low : b + high]:
            return limit
        while high - low > 1:
            middle = (low + high) // 2
            if buffer[a + low : a + middle] == buffer[b + low : b + middle]:
                low = middle
            else:
                high = middle
        return low

    def insert(self, start: int, end: int) -> None:
        buffer, size = self.buffer, end - start
        if self.root is None:
            self.root = [size, None, [(start, end)]]
            return
        node = self.root
        while node[1] is not None:  # blindly by the bytes at branches, then to any leaf
            depth = node[0]
            after = node[1].get(buffer[start + depth] if depth < size else -1)
            node = after if after is not None else next(iter(node[1].values()))
        leaf = node[2][0]
        shared = self.common(start, leaf[0], min(size, leaf[1] - leaf[0]))
        up, node = None, self.root
        while node[1] is not None and node[0] <= shared:
            if node[0] == shared:
                break
            up, node = node, node[1][buffer[start + node[0]]]
        if node[1] is None and shared == size == node[0]:
            node[2].append((start, end))
            return
        byte = buffer[start + shared] if shared < size else -1
        new = [size, None, [(start, end)]]
        if node[1] is not None and node[0] == shared:
            if byte in node[1]:  # another suffix ends here
                node[1][byte][2].append((start, end))
            else:
                node[1][byte] = new
            return
        other = leaf[0] + shared
        split = [shared, {byte: new, buffer[other] if other < leaf[1] else -1: node}, None]
        if up is None:
            self.root = split
        else:
            up[1][buffer[start + up[0]]] = split

    def leaves(self) -> list[tuple[list[tuple[int, int]], int]]:
        """Leaves in order, each with the longest common prefix that it has with another suffix."""
        out, stack = [], [(self.root, 0)] if self.root else []
        while stack:
            node, above = stack.pop()
            if node[1] is None:
                out.append((node[2], node[0] if len(node[2]) > 1 else above))
            else:
                stack += [(node[1][byte], node[0]) for byte in sorted(node[1], reverse=True)]
        return out


def _words(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; zeros follow the end."""
    padded = np.concatenate([buffer, np.zeros(8, "u1")]).astype("u8")
    out = np.zeros(len(buffer) + 1, "u8")
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(buffer) + 1]
    return out


def repeated(buffer: bytes, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Whether the `length` bytes at each start occur at another start of its group.

    starts: places in the buffer, in runs that go on by one; first marks the beginning of a run, ends is where the run's bytes
    end, at least `length` behind each start. groups: numbers of starts to be compared with each other.
    """
    out = np.zeros(len(starts), bool)
    words = _words(np.frombuffer(buffer, "u1"))
    left, group = np.arange(len(starts)), groups
    shallow = min(SHALLOW, length) // 8 * 8
    for depth in range(0, shallow, 8):
        word = words[starts[left] + depth]
        order = np.lexsort((word, group))
        left, group, word = left[order], group[order], word[order]
        new = np.ones(len(left), bool)
        new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        left = left[~alone]
    if not len(left):
        return out
    order = np.lexsort((left, group))
    left, group = left[order], group[order]
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(heads, len(left)))
    number = np.full(len(starts) + 1, -1, "i8")
    number[left] = np.repeat(np.arange(len(heads)), sizes)
    before = np.where(first[left], -1, number[left - 1])
    low, high = np.minimum.reduceat(before, heads), np.maximum.reduceat(before, heads)
    chained = (low == high) & (low >= 0)
    chained[chained] = sizes[low[chained]] == sizes[chained]
    chain = np.ones(len(heads), "i8")
    follows = np.full(len(heads), -1, "i8")
    follows[low[chained]] = np.flatnonzero(chained)
    # Chain lengths by doubling: each step joins what follows.
    ahead, reach = follows.copy(), chain
    while (ahead >= 0).any():
        has = ahead >= 0
        step = np.where(has, reach[ahead], 0)
        reach = reach + step
        ahead = np.where(has, ahead[ahead], -1)
    for g in np.flatnonzero(~chained):
        members = left[heads[g] : heads[g] + sizes[g]]
        trie = BlindTrie(buffer, shallow)
        at = dict(zip(starts[members].tolist(), members.tolist(), strict=True))
        for start, member in at.items():
            trie.insert(start, int(ends[member]))
        for leaf, shared in trie.leaves():
            count = min(int(reach[g]), shared - length + 1)
            if count > 0:
                for start, _ in leaf:
                    out[at[start] : at[start] + count] = True
    return out
