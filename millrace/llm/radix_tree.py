"""Adaptive radix tree over byte strings: nodes grow through four layouts, and chains of single children are one path."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

# The most children of each layout.
SMALL, MEDIUM, LARGE, FULL = 4, 16, 48, 256


class Node:
    """path: bytes from the parent's branch to here, the branching byte included; held: the values of strings that end here.

    Up to MEDIUM children are sorted keys beside their nodes, up to LARGE an index of 256 bytes into a list of nodes, then one slot a byte.
    """

    __slots__ = ("path", "held", "layout", "keys", "nodes")

    def __init__(self, path: bytes, held: list | None = None):
        self.path, self.held = path, held if held is not None else []
        self.layout, self.keys, self.nodes = SMALL, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= MEDIUM:
            at = bisect_left(self.keys, byte)
            return self.nodes[at] if at < len(self.keys) and self.keys[at] == byte else None
        if self.layout == LARGE:
            at = self.keys[byte]
            return self.nodes[at - 1] if at else None
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> None:
        """Sets the child of a byte, in place of one that is there."""
        if self.layout <= MEDIUM:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.nodes[at] = node
                return
            if len(self.nodes) < self.layout:
                self.keys.insert(at, byte)
                self.nodes.insert(at, node)
                return
        elif self.layout == LARGE:
            at = self.keys[byte]
            if at:
                self.nodes[at - 1] = node
                return
            if len(self.nodes) < LARGE:
                self.nodes.append(node)
                self.keys[byte] = len(self.nodes)
                return
        else:
            self.nodes[byte] = node
            return
        self._grow()
        self.put(byte, node)

    def _grow(self) -> None:
        if self.layout == SMALL:
            self.layout = MEDIUM
        elif self.layout == MEDIUM:
            index = bytearray(256)
            for place, byte in enumerate(self.keys):
                index[byte] = place + 1
            self.layout, self.keys = LARGE, index
        else:
            slots: list[Node | None] = [None] * FULL
            for byte, place in enumerate(self.keys):
                if place:
                    slots[byte] = self.nodes[place - 1]
            self.layout, self.keys, self.nodes = FULL, bytearray(), slots

    def children(self) -> Iterator[Node]:
        """Children by rising byte."""
        if self.layout <= MEDIUM:
            yield from self.nodes
        elif self.layout == LARGE:
            yield from (self.nodes[place - 1] for place in self.keys if place)
        else:
            yield from (node for node in self.nodes if node is not None)


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def add(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.child(key[at])
            if child is None:
                node.put(key[at], Node(key[at:], [value]))
                return
            shared = _shared(child.path, key, at)
            if shared < len(child.path):
                fork = Node(child.path[:shared])
                node.put(key[at], fork)
                child.path = child.path[shared:]
                fork.put(child.path[0], child)
                child = fork
            node, at = child, at + shared
        node.held.append(value)

    def walk(self) -> Iterator[tuple[Node, int]]:
        """All nodes with the depth of their last byte, each after its parent, siblings by rising byte."""
        stack = [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            yield node, depth
            stack.extend((c, depth + len(c.path)) for c in reversed(list(node.children())))


def _shared(path: bytes, key: bytes, at: int) -> int:
    """Bytes that a path and a key from a place on have in common, found by halving."""
    most = min(len(path), len(key) - at)
    if path[:most] == key[at : at + most]:
        return most
    low, high = 0, most - 1
    while low < high:
        middle = (low + high + 1) // 2
        if path[:middle] == key[at : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low
