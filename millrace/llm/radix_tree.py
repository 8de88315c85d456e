"""An adaptive radix tree over byte strings, for use inside tasks.

An inner node holds its children in the smallest of four layouts that fits
them (4, 16, 48 or 256) and moves on to the next when it is full.  A path
without branches is one node with a compressed prefix.  A key may end where
others go on: its value then lies in an inner node.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any


class Sorted:
    """Up to ``room`` children beside their bytes, in order: the layouts of 4 and 16."""

    __slots__ = ("room", "labels", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.labels, self.nodes = room, bytearray(), []

    def find(self, label: int) -> Node | None:
        at = bisect_left(self.labels, label)
        return self.nodes[at] if at < len(self.labels) and self.labels[at] == label else None

    def put(self, label: int, node: Node) -> Sorted | Indexed:
        at = bisect_left(self.labels, label)
        if at < len(self.labels) and self.labels[at] == label:
            self.nodes[at] = node
            return self
        if len(self.labels) == self.room:
            larger = Sorted(16) if self.room == 4 else Indexed()
            for old, child in self.items():
                larger.put(old, child)
            return larger.put(label, node)
        self.labels.insert(at, label)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.labels, self.nodes)


class Indexed:
    """Up to 48 children behind a table of 256 places."""

    __slots__ = ("places", "nodes")

    def __init__(self):
        self.places, self.nodes = bytearray(256), []

    def find(self, label: int) -> Node | None:
        place = self.places[label]
        return self.nodes[place - 1] if place else None

    def put(self, label: int, node: Node) -> Indexed | Direct:
        place = self.places[label]
        if place:
            self.nodes[place - 1] = node
            return self
        if len(self.nodes) == 48:
            larger = Direct()
            for old, child in self.items():
                larger.put(old, child)
            return larger.put(label, node)
        self.nodes.append(node)
        self.places[label] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((label, self.nodes[place - 1]) for label, place in enumerate(self.places) if place)


class Direct:
    """One place per byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes: list[Node | None] = [None] * 256

    def find(self, label: int) -> Node | None:
        return self.nodes[label]

    def put(self, label: int, node: Node) -> Direct:
        self.nodes[label] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((label, node) for label, node in enumerate(self.nodes) if node is not None)


class Node:
    """``prefix`` follows the byte that leads here; ``value`` is that of the key that ends here."""

    __slots__ = ("prefix", "value", "children")

    def __init__(self, prefix: bytes, value: Any = None):
        self.prefix, self.value, self.children = prefix, value, None

    def put(self, label: int, node: Node) -> None:
        self.children = (Sorted() if self.children is None else self.children).put(label, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return iter(()) if self.children is None else self.children.items()


def _shared(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` stand in ``b`` from ``at`` on."""
    if b.startswith(a, at):
        return len(a)
    end = min(len(a), len(b) - at)
    for k in range(end):
        if a[k] != b[at + k]:
            return k
    return end


class RadixTree:
    """Keys and their values, none of them None; a key put again takes the new value."""

    def __init__(self):
        self.root = Node(b"")

    def put(self, key: bytes, value: Any) -> None:
        above, label, node, at = None, 0, self.root, 0
        while True:
            same = _shared(node.prefix, key, at)
            if same < len(node.prefix):  # the path divides within the prefix
                upper = Node(node.prefix[:same])
                upper.put(node.prefix[same], node)
                node.prefix = node.prefix[same + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.put(label, upper)
                node = upper
            at += same
            if at == len(key):
                node.value = value
                return
            above, label = node, key[at]
            child = node.children.find(label) if node.children is not None else None
            if child is None:
                node.put(label, Node(key[at + 1 :], value))
                return
            node, at = child, at + 1

    def get(self, key: bytes) -> Any:
        node, at = self.root, 0
        while True:
            if not key.startswith(node.prefix, at):
                return None
            at += len(node.prefix)
            if at == len(key):
                return node.value
            node = node.children.find(key[at]) if node.children is not None else None
            if node is None:
                return None
            at += 1

    def upwards(self) -> Iterator[tuple[Node, int, int]]:
        """Every node after its children, with the depth in bytes at which its parent ends (-1: none) and its own.

        Children come in the order of their bytes.
        """
        stack = [(self.root, -1, len(self.root.prefix), False)]
        while stack:
            node, begin, end, seen = stack.pop()
            if seen or node.children is None:
                yield node, begin, end
                continue
            stack.append((node, begin, end, True))
            stack += reversed([(child, end, end + 1 + len(child.prefix), False) for _, child in node.items()])
