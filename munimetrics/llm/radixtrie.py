"""Patricia trie over byte strings whose terminal nodes own the best row; spills by subtree."""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

#: What a key costs beyond its bytes: node, dictionary, owner.
OVERHEAD = 400


class Node:
    __slots__ = ("children", "label", "owner")

    def __init__(self, label: bytes, owner=None):
        self.label, self.owner, self.children = label, owner, {}


def better(one: tuple, other: tuple) -> tuple:
    """Owners are ``(code points, identifier, rows)``: most code points, then smallest identifier; rows add up."""
    first = min(one, other, key=lambda o: (-o[0], o[1] is None, o[1] if o[1] is not None else 0))
    return first[0], first[1], one[2] + other[2]


def shared_length(one: bytes, other: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Holds at most about ``budget`` bytes; beyond, the largest subtree below the root goes to a task-local file.

    Keys that later fall into a spilled subtree are appended to its file. Such a file is unnamed (it is gone with
    the task, and a lost task is run again from its input); it is rebuilt on its own when the trie is read.
    """

    def __init__(self, budget: int = 256 << 20, skip: int = 0):
        self.root, self.budget, self.skip = Node(b""), budget, skip
        self.size: dict[int, int] = {}
        self.spilled: dict[int, tempfile._TemporaryFileWrapper] = {}

    def insert(self, key: bytes, owner: tuple) -> bool:
        """Whether the key was new here; an appended key of a spilled subtree counts as new."""
        if len(key) <= self.skip:
            return self._put(self.root, key[self.skip :], owner)
        head = key[self.skip]
        if head in self.spilled:
            pickle.dump((key, owner), self.spilled[head])
            return True
        new = self._put(self.root, key[self.skip :], owner)
        if new:
            self.size[head] = self.size.get(head, 0) + len(key) + OVERHEAD
            if sum(self.size.values()) > self.budget:
                self._spill(max(self.size, key=self.size.get))
        return new

    @staticmethod
    def _put(node: Node, rest: bytes, owner: tuple) -> bool:
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = Node(rest, owner)
                return True
            if rest.startswith(child.label):
                node, rest = child, rest[len(child.label) :]
                continue
            shared = shared_length(rest, child.label)
            fork = Node(rest[:shared])
            node.children[rest[0]] = fork
            child.label = child.label[shared:]
            fork.children[child.label[0]] = child
            node, rest = fork, rest[shared:]
        if node.owner is None:
            node.owner = owner
            return True
        node.owner = better(node.owner, owner)
        return False

    def _spill(self, head: int) -> None:
        file = tempfile.TemporaryFile()
        prefix = b"\0" * self.skip
        for key, owner in self._walk(self.root.children.pop(head)):
            pickle.dump((prefix + key, owner), file)
        self.spilled[head] = file
        self.size.pop(head)

    @staticmethod
    def _walk(top: Node) -> Iterator[tuple[bytes, tuple]]:
        stack = [(top, top.label)]
        while stack:
            node, key = stack.pop()
            if node.owner is not None:
                yield key, node.owner
            stack.extend((child, key + child.label) for child in node.children.values())

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """Every distinct key with its owner. A spilled subtree is read below its first byte, and may spill again."""
        for key, owner in self._walk(self.root):
            yield key, owner
        for file in self.spilled.values():
            file.seek(0)
            inner = RadixTrie(self.budget, self.skip + 1)
            heads = {}
            while True:
                try:
                    key, owner = pickle.load(file)
                except EOFError:
                    break
                heads.setdefault("prefix", key[: self.skip + 1])
                inner.insert(key, owner)
            for key, owner in inner.items():
                yield heads["prefix"][self.skip :] + key, owner
            file.close()
