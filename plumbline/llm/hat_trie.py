"""A burstable trie of word ids that counts phrases and spills whole subtrees as sorted runs.

Inner nodes branch on a word id.  Below them lie containers: hash tables from the
ids that are left of a phrase to its count.  A container of more than `burst`
entries becomes an inner node with a container per next id, as long as two or more
ids are left, so the trie stays as shallow as the data allows.  Beyond `most`
entries the largest subtrees below the root are given out, each as one run in the
order of its phrases, and forgotten; the same phrase may return in a later run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

#: Bytes of a word id; ids are big-endian, so runs in byte order are in the order of ids.
WIDTH = 8


class Container:
    """Counts by the ids that are left of a phrase."""

    __slots__ = ("counts",)

    def __init__(self) -> None:
        self.counts: dict[bytes, int] = {}

    def entries(self, head: bytes) -> Iterator[tuple[bytes, int]]:
        for rest in sorted(self.counts):
            yield head + rest, self.counts[rest]


class Inner:
    """Children by the next id."""

    __slots__ = ("children",)

    def __init__(self) -> None:
        self.children: dict[bytes, Container | Inner] = {}

    def entries(self, head: bytes) -> Iterator[tuple[bytes, int]]:
        for word in sorted(self.children):
            yield from self.children[word].entries(head + word)


class HatTrie:
    """Counts of phrases under roots (a language each) and first words."""

    def __init__(self, burst: int = 4096, most: int = 1_000_000):
        self.burst, self.most = burst, most
        self.trees: dict[tuple[str, bytes], Container | Inner] = {}
        self.sizes: dict[tuple[str, bytes], int] = {}
        self.total = 0

    def add(self, root: str, first: bytes, rests: Sequence[bytes], counts: Sequence[int]) -> None:
        """Phrases that begin with one word, and how often each occurs."""
        tree = self.trees.get((root, first))
        if tree is None:
            tree = self.trees[root, first] = Container()
            self.sizes[root, first] = 0
        if isinstance(tree, Container):
            new = self._count(tree, rests, counts)
            if len(tree.counts) > self.burst:
                self.trees[root, first] = self._burst(tree)
        else:
            new = sum(self._descend(tree, rest, n) for rest, n in zip(rests, counts, strict=True))
        self.sizes[root, first] += new
        self.total += new

    def _count(self, leaf: Container, rests: Sequence[bytes], counts: Sequence[int]) -> int:
        table = leaf.counts
        before = len(table)
        for rest, n in zip(rests, counts, strict=True):
            table[rest] = table.get(rest, 0) + n
        return len(table) - before

    def _descend(self, node: Inner, rest: bytes, n: int) -> int:
        """Count one phrase below a node; 1 if it is new."""
        while True:
            word, rest = rest[:WIDTH], rest[WIDTH:]
            child = node.children.get(word)
            if child is None:
                child = node.children[word] = Container()
            if isinstance(child, Container):
                new = self._count(child, (rest,), (n,))
                if len(child.counts) > self.burst:
                    node.children[word] = self._burst(child)
                return new
            node = child

    def _burst(self, leaf: Container) -> Container | Inner:
        """The same entries one word deeper; a container whose phrases end with the next word stays."""
        if any(len(rest) <= WIDTH for rest in leaf.counts):
            return leaf
        node = Inner()
        for rest, n in leaf.counts.items():
            child = node.children.setdefault(rest[:WIDTH], Container())
            child.counts[rest[WIDTH:]] = n
        for word, child in node.children.items():
            if len(child.counts) > self.burst:
                node.children[word] = self._burst(child)
        return node

    def overflow(self) -> Iterator[tuple[str, bytes, int]]:
        """Runs of the largest subtrees, until half of the room is free; nothing while there is room."""
        if self.total <= self.most:
            return
        for key in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.total <= self.most // 2:
                break
            yield from self._spill(key)

    def rest(self) -> Iterator[tuple[str, bytes, int]]:
        """Runs of all subtrees that are left."""
        for key in sorted(self.sizes):
            yield from self._spill(key)

    def _spill(self, key: tuple[str, bytes]) -> Iterator[tuple[str, bytes, int]]:
        root, first = key
        tree = self.trees.pop(key)
        self.total -= self.sizes.pop(key)
        for phrase, n in tree.entries(first):
            yield root, phrase, n
