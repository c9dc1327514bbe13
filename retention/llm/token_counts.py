"""Token counts by rank-synchronous array merging.

A batch of pre-tokens is one ragged array of symbols. Each step finds, for every sequence at once,
the rank of its lowest-ranked adjacent pair, merges all occurrences of that pair in the sequence
from left to right, and looks up only the pairs that changed. A sequence without a known pair is
finished: the symbols that survive are its tokens. Merging all occurrences of one rank together
equals merging them one at a time, as a pair that holds a merged symbol has a higher rank than
the pair that made it.

Defined cases: null or empty text: 0 bytes, 0 tokens; repeated doc_ids: one row each; empty table:
no rows. Texts are never truncated, and read in blocks, so a worker's memory doesn't grow with them.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from retention.llm.common import map_rows, texts_of
from retention.llm.pieces import Cached

NONE = np.int64(1 << 40)


def byte_chars() -> dict[str, int]:
    """The byte-level alphabet's characters and their bytes: printable Latin-1 bytes stand for
    themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Pair ranks of a byte-level BPE ``tokenizers`` file as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, to_byte = spec["model"]["vocab"], byte_chars()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.byte_id = np.zeros(256, np.int64)
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        self.base = np.int64(max(vocab.values()) + 2)
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.rank = np.append(order.astype(np.int64), NONE)
        self.made = np.append(np.array([vocab[a + b] for a, b in merges], np.int64)[order], 0)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or NONE, merged symbol) of each pair."""
        key = left * self.base + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], NONE), self.made[at]

    def merge(self, pieces: list[bytes]) -> np.ndarray:
        """The number of surviving symbols of each piece."""
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = lens.copy()
        sym = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        seq = np.repeat(np.arange(len(pieces)), lens)
        rank, made = self._ranks(sym, seq, np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            size = np.diff(np.append(first, len(seq)))
            least = np.minimum.reduceat(rank, first)
            done = least >= NONE
            out[seq[first[done]]] = size[done]
            if done.any():
                keep = np.repeat(~done, size)
                sym, seq, rank, made = sym[keep], seq[keep], rank[keep], made[keep]
                size, least = size[~done], least[~done]
                if not len(sym):
                    break
            hit = rank == np.repeat(least, size)
            # in a run of overlapping pairs (a a a ...) every second one is taken, from the left
            at = np.arange(len(sym))
            start = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), at, 0))
            hit &= (at - start) % 2 == 0
            sym = np.where(hit, made, sym)
            keep = ~np.append(False, hit[:-1])
            moved = np.cumsum(keep)[hit] - 1
            sym, seq, rank, made = sym[keep], seq[keep], rank[keep], made[keep]
            touched = np.zeros(len(sym), bool)
            touched[moved] = touched[np.maximum(moved - 1, 0)] = True
            changed = np.flatnonzero(touched)
            rank[changed], made[changed] = self._ranks(sym, seq, changed)
        return out

    def _ranks(self, sym, seq, at):
        """Ranks of the pairs that begin at the given places; NONE at the end of a sequence."""
        nxt = np.minimum(at + 1, len(sym) - 1)
        rank, made = self.lookup(sym[at], sym[nxt])
        return np.where((at + 1 < len(sym)) & (seq[at] == seq[nxt]), rank, NONE), made


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Cached:
    """A worker's cached counter of the vocabulary file."""
    import regex

    merges, split = MergeTable(path), regex.compile(pattern).findall
    if len(merges.special) > 1:
        raise ValueError("more than one added token")
    return Cached(split, lambda pieces: merges.merge([p.encode() for p in pieces]).tolist(), sum, merges.special[0] if merges.special else None)


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of whole texts: tokens as the ``tokenizers`` library
    gives them for ``vocabulary`` without post-processing; an added token's string counts as one
    token. ``over_limit``: more than ``limit`` tokens. A narrow map: no shuffle, one row per row."""

    def rows(source):
        count = counter(vocabulary, pattern)
        for group in grouped(source):
            n = [0] * len(group)

            def take(i, values):
                n[i] += 1 if values is None else sum(values)

            count.feed(((i, r["text"]) for i, r in enumerate(group)), take)
            for r, k in zip(group, n):
                yield r["doc_id"], len(r["text"].encode()), k, k > limit

    return map_rows(texts_of(docs), rows, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def grouped(source, chars: int = 1 << 20):
    """Rows in groups of about ``chars`` code points of text."""
    held, size = [], 0
    for r in source:
        held.append(r)
        size += len(r["text"])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held
