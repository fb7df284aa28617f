"""Adaptive radix tree over byte keys.

A node keeps the bytes that all its keys share (path compression) and its
children in one of four layouts, grown as they fill: up to 4 and up to 16
sorted bytes, up to 48 children behind a 256-entry index, 256 direct places.
A key that is alone below a branch is one node with all its remaining bytes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to ``room`` children by sorted byte (room 4, then 16)."""

    __slots__ = ("room", "bytes", "kids")

    def __init__(self, room: int):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def find(self, byte: int):
        at = bisect_left(self.bytes, byte)
        return self.kids[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, kid) -> "Sorted | Indexed":
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.bytes) == self.room:
            grown = Sorted(16) if self.room == 4 else Indexed()
            for b, k in self.items():
                grown.put(b, k)
            return grown.put(byte, kid)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def items(self) -> Iterator:
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children behind an index of 256 bytes (0: none)."""

    __slots__ = ("index", "kids")

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def find(self, byte: int):
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid) -> "Indexed | Direct":
        at = self.index[byte]
        if at:
            self.kids[at - 1] = kid
            return self
        if len(self.kids) == 48:
            grown = Direct()
            for b, k in self.items():
                grown.put(b, k)
            return grown.put(byte, kid)
        self.kids.append(kid)
        self.index[byte] = len(self.kids)
        return self

    def items(self) -> Iterator:
        return ((b, self.kids[at - 1]) for b, at in enumerate(self.index) if at)


class Direct:
    """A place for every byte."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def find(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> "Direct":
        self.kids[byte] = kid
        return self

    def items(self) -> Iterator:
        return ((b, k) for b, k in enumerate(self.kids) if k is not None)


class Node:
    __slots__ = ("prefix", "value", "below")

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value, self.below = prefix, value, None

    def put(self, byte: int, kid: "Node") -> None:
        self.below = (self.below or Sorted(4)).put(byte, kid)


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        mid = (low + n) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            n = mid
    return low


class Tree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        node, at, parent, edge = self.root, 0, None, 0
        if node is None:
            self.root = Node(key, value)
            return
        while True:
            prefix = node.prefix
            n = shared(prefix, key[at:at + len(prefix)])
            if n < len(prefix):
                upper = Node(prefix[:n])
                node.prefix = prefix[n + 1:]
                upper.put(prefix[n], node)
                if at + n == len(key):
                    upper.value = value
                else:
                    upper.put(key[at + n], Node(key[at + n + 1:], value))
                if parent is None:
                    self.root = upper
                else:
                    parent.put(edge, upper)
                return
            at += n
            if at == len(key):
                node.value = value
                return
            edge = key[at]
            kid = node.below.find(edge) if node.below else None
            at += 1
            if kid is None:
                node.put(edge, Node(key[at:], value))
                return
            parent, node = node, kid
