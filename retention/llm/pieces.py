"""Splitting texts for byte-level BPE vocabularies, with a cache of repeated stretches.

``public_tokenizers.PATTERN`` never lets a piece span a single space between two characters that
aren't white space, nor a single line break between such, nor the end of a word before white space.
So a text may be cut before each such space, on both sides of such a break and before its trailing
white space, and the cuts handled alone. Most are a space and a word, which repeat: their results
are kept in a bounded cache per worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: Cut points that hold for any text (``\s`` here covers the pattern's ``\s``).
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space beside white space: not every space or break is a cut point then.
_LOOSE = re.compile(r"\s\s")
#: Code points of a block, and of the blocks that are resolved together.
BLOCK = 1 << 20
#: Entries of each of the cache's two generations.
CACHE_ENTRIES = 500_000


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """The text in stretches of about ``size`` code points, cut where no piece crosses."""
    at = 0
    while len(text) - at > 2 * size and (m := _CUT.search(text, at + size)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def cuts(text: str) -> list[str]:
    """The stretches of a text that can be handled alone."""
    body = text.rstrip(" \t\n\r")
    if body[-1:].isspace():
        body = text
    tail = text[len(body):]
    if "\0" in body or _LOOSE.search(body):
        at = [0, *(m.start() for m in _CUT.finditer(body)), len(body)]
        parts = [body[i:j] for i, j in zip(at, at[1:])]
    else:
        parts = body.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
    if not parts[0]:
        del parts[0]
    if tail:
        parts.append(tail)
    return parts


class Cached:
    """Applies ``resolve`` (distinct pieces -> a value each) to whole texts. ``split`` cuts a stretch into
    pieces (None: a stretch is one piece), ``join`` puts the values of its pieces together. The cache
    has two generations: when the young one is full it becomes the old one, and what is used of that
    moves on, so that frequent stretches stay. Results don't depend on it."""

    def __init__(self, split: Callable[[str], list[str]] | None, resolve: Callable[[list[str]], list], join: Callable, special: str | None = None):
        self.split, self.resolve, self.join, self.special = split, resolve, join, special
        self.store: dict = {}
        self.old: dict = {}

    def feed(self, texts: Iterator[tuple[int, str]], take: Callable[[int, Iterator | None], None]) -> None:
        """For each (key, text), calls ``take(key, values)`` once per block in order, and
        ``take(key, None)`` for each occurrence of the special string."""
        held: list[tuple[int, list[str] | None]] = []
        size = 0
        for key, text in texts:
            for n, segment in enumerate(text.split(self.special) if self.special else (text,)):
                if n:
                    held.append((key, None))
                for block in blocks(segment) if segment else ():
                    held.append((key, cuts(block)))
                    size += len(block)
                    if size >= BLOCK:
                        self._flush(held, take)
                        held, size = [], 0
        self._flush(held, take)

    def _flush(self, held, take) -> None:
        store = self.store
        self._add(set().union(*(parts for _, parts in held if parts)).difference(store))
        for key, parts in held:
            take(key, None if parts is None else map(store.__getitem__, parts))
        if len(store) > CACHE_ENTRIES:
            self.store, self.old = {}, store

    def _known(self, stretches: set[str]) -> set[str]:
        """Takes what the old generation has; returns the others."""
        old = self.old
        kept = [s for s in stretches if s in old]
        self.store.update(zip(kept, map(old.__getitem__, kept)))
        return stretches.difference(kept)

    def _add(self, stretches: set[str]) -> None:
        stretches = self._known(stretches)
        if self.split is None:
            fresh = list(stretches)
            self.store.update(zip(fresh, self.resolve(fresh)))
            return
        cut = {s: self.split(s) for s in stretches}
        fresh = list(self._known(set().union(*cut.values()).difference(self.store)))
        self.store.update(zip(fresh, self.resolve(fresh)))
        get = self.store.__getitem__
        self.store.update([(s, self.join(map(get, ps))) for s, ps in cut.items() if len(ps) > 1])
