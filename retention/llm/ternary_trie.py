"""A ternary search tree over sequences of turn ids, and what its nodes hold below them.

A tree node has an id, the nodes of smaller and larger ids at the same place, and the node of the
next place; so each is one prefix. Sequences of a sorted list go in by medians, the middle one
first, which keeps the choices at each place balanced. Nothing here recurses.
"""

from __future__ import annotations

import hashlib

ROOT_KEY = hashlib.sha256(b"").digest()


def next_key(key: bytes, turn: int) -> bytes:
    """The name of a prefix, from that of the prefix before it and its last turn's id."""
    return hashlib.sha256(key + turn.to_bytes(8, "little", signed=True)).digest()


class TernaryTree:
    """Node 0 is the root, the empty prefix."""

    def __init__(self):
        self.turn, self.smaller, self.larger, self.first = [0], [0], [0], [0]
        self.parent, self.depth, self.chars = [0], [0], [0]
        self.members, self.least, self.ends = [0], [None], [None]

    def _child(self, at: int, turn: int, chars: int) -> int:
        """The node of ``turn`` after node ``at``, made if it isn't there."""
        link, here, node = self.first, at, self.first[at]
        while node:
            here_turn = self.turn[node]
            if turn == here_turn:
                return node
            link, here = (self.smaller, node) if turn < here_turn else (self.larger, node)
            node = link[here]
        node = link[here] = len(self.turn)
        for column, value in ((self.turn, turn), (self.smaller, 0), (self.larger, 0), (self.first, 0), (self.parent, at),
                              (self.depth, self.depth[at] + 1), (self.chars, chars), (self.members, 0), (self.least, None), (self.ends, None)):
            column.append(value)
        return node

    def insert(self, turns, chars, members: int, least: int, ends: str) -> int:
        at = 0
        for turn, n in zip(turns, chars):
            at = self._child(at, turn, n)
        self.members[at], self.least[at], self.ends[at] = members, least, ends
        return at

    def insert_sorted(self, rows: list) -> list[int]:
        """Inserts rows (turns, chars, members, least, ends), sorted by turns and distinct, by medians;
        returns the node that each ends at."""
        at = [0] * len(rows)
        spans = [(0, len(rows))]
        while spans:
            low, high = spans.pop()
            if low < high:
                middle = (low + high) // 2
                at[middle] = self.insert(*rows[middle])
                spans += [(low, middle), (middle + 1, high)]
        return at

    def order(self) -> list[int]:
        """All nodes, each after its prefixes: a walk with a stack of links not yet followed."""
        out, links = [0], [self.first[0]]
        while links:
            node = links.pop()
            if node:
                out.append(node)
                links += [self.larger[node], self.first[node], self.smaller[node]]
        return out

    def path(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        out = [node]
        while node:
            node = self.parent[node]
            out.append(node)
        return out[::-1]

    def accumulate(self, open_nodes: set[int]) -> tuple[list[int], list[int], list[int]]:
        """Adds members and the least member of each node to its prefixes. Returns (children, leaves,
        saved) of each node without what ``open_nodes`` themselves count: other shards share these, and
        what they are is known only when all are merged."""
        size = len(self.turn)
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        for node in reversed(self.order()):
            if node not in open_nodes:
                leaves[node] += not children[node]
                saved[node] += (self.members[node] - 1) * self.chars[node]
            if node:
                up = self.parent[node]
                self.members[up] += self.members[node]
                if self.least[up] is None or self.least[node] < self.least[up]:
                    self.least[up] = self.least[node]
                children[up] += node not in open_nodes
                leaves[up] += leaves[node]
                saved[up] += saved[node]
        return children, leaves, saved
