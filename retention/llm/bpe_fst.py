"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

Encoding rests on two facts about BPE merges: the encoding of every prefix of a text is fixed by
its last token and the encoding of the rest before that token, and a token may follow another only
if the merges of their joined bytes give back just these two. So after each byte there is exactly
one last token. A later token can begin only where the bytes read since are the beginning of some
token; a state of the transducer holds those open places (a node of the vocabulary's trie, the
token before it, and the tokens not yet emitted up to it). Tokens that all open places share are
settled and are emitted: the lookahead is at most the longest token's bytes. States and transitions
are made when first met and then kept, so repeated text costs one table step per byte.

Decoding feeds token bytes in blocks to an incremental UTF-8 state machine, which carries a
character that is split between tokens or blocks.

Defined cases: null or empty text: no tokens, digests of no bytes; repeated rows: one row each;
empty table: no rows; long texts are read in blocks, long pieces byte by byte.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from retention.llm.common import map_rows, texts_of
from retention.llm.pieces import Cached
from retention.llm.token_counts import grouped

#: Transitions kept by a worker; beyond it the table is emptied and made anew as needed.
MAX_TRANSITIONS = 1_500_000
NO_PAIR = 1 << 40
#: Ids decoded at once.
DECODE_IDS = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: list[bool] = [False]
        for t, i in ranks.items():
            node = 0
            for b in t:
                self.inner[node] = True
                if (k := node << 8 | b) not in self.child:
                    self.child[k] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.child[k]
            self.token[node] = i
        self._follows: dict[tuple[int, int], bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, bytes]] = {}
        self.ends: dict[int, bytes] = {}
        self.start = self._state(((0, -1, ()),))

    def _state(self, places: tuple) -> int:
        if (n := self.number.get(places)) is None:
            n = self.number[places] = len(self.states)
            self.states.append(places)
        return n

    def _split(self, token: int) -> tuple[tuple[int, int, int], ...] | None:
        """The merges of a token's bytes as (left, right, rank), the last first; None if they don't
        give the token back (then no text is encoded with it unless it is a whole piece)."""
        parts, done = [self.ranks[self.bytes_of[token][i:i + 1]] for i in range(len(self.bytes_of[token]))], []
        while len(parts) > 1:
            rank, at = min((self.pair(a, b), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NO_PAIR:
                return None
            done.append((parts[at], parts[at + 1], rank))
            parts[at:at + 2] = [rank]
        return tuple(reversed(done)) if parts == [token] else None

    def pair(self, a: int, b: int) -> int:
        """The rank (and id) of the token that two tokens merge to, or NO_PAIR."""
        return self.ranks.get(self.bytes_of[a] + self.bytes_of[b], NO_PAIR)

    def _edge(self, token: int, side: int) -> tuple[tuple[int, int], ...]:
        """The tokens that stand at a token's end (side 1) or beginning (0) while its bytes merge,
        each with the rank at which it is merged on. Empty: the merges don't give the token."""
        if (edge := self._edges[side].get(token)) is None:
            edge, t, until = [], token, NO_PAIR
            while t is not None:
                edge.append((t, until))
                split = self._split(t)
                if split is None:
                    edge = []
                    break
                t, until = (split[0][side], split[0][2]) if split else (None, 0)
            self._edges[side][token] = edge = tuple(edge)
        return edge

    def follows(self, last: int, token: int) -> bool:
        """Whether the merges keep ``token`` whole after ``last`` (-1: at the beginning): no token at
        the end of ``last`` merges with one at the beginning of ``token`` while both stand there.
        Of equal ranks the left one goes first."""
        if (ok := self._follows.get((last, token))) is None:
            right = self._edge(token, 0)
            ok = bool(right) and (last < 0 or not any((r := self.pair(a, b)) < ends and r <= on for a, ends in self._edge(last, 1) for b, on in right))
            if len(self._follows) > MAX_TRANSITIONS:
                self._follows.clear()
            self._follows[last, token] = ok
        return ok

    def _step(self, key: int) -> tuple[int, bytes]:
        byte, places, ended = key & 255, [], None
        for node, last, open_ in self.states[key >> 8]:
            if (node := self.child.get(node << 8 | byte)) is None:
                continue
            if ended is None and (t := self.token[node]) >= 0 and self.follows(last, t):
                ended = (0, t, (*open_, t))
            if self.inner[node]:
                places.append((node, last, open_))
        places.append(ended)
        settled = 0
        while all(len(p[2]) > settled for p in places) and len({p[2][settled] for p in places}) == 1:
            settled += 1
        out = np.array(places[0][2][:settled], "<u4").tobytes()
        step = self._state(tuple((n, last, o[settled:]) for n, last, o in places)), out
        self.steps[key] = step
        return step

    def encode(self, piece: bytes) -> bytes:
        """The ids of a pre-token as little-endian unsigned 32-bit integers."""
        if (whole := self.ranks.get(piece)) is not None:
            return whole.to_bytes(4, "little")
        if len(self.steps) > MAX_TRANSITIONS:
            self.clear()
        state, out, steps = self.start, b"", self.steps
        for b in piece:
            if (step := steps.get(state << 8 | b)) is None:
                step = self._step(state << 8 | b)
            state, ids = step
            if ids:
                out += ids
        if (end := self.ends.get(state)) is None:
            end = self.ends[state] = np.array(self.states[state][-1][2], "<u4").tobytes()
        return out + end


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tuple[Cached, list[bytes]]:
    import regex

    ranks = load_ranks(path)
    fst, split = Transducer(ranks), regex.compile(pattern).findall
    words = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        words[i] = t
    return Cached(split, lambda pieces: [fst.encode(p.encode()) for p in pieces], b"".join), words


class Decoder:
    """Incremental decoding of ids: whole characters come out, an unfinished one waits."""

    def __init__(self, words: list[bytes]):
        self.words, self.state = words, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes, last: bool = False) -> str:
        return self.state.decode(b"".join(map(self.words.__getitem__, np.frombuffer(ids, "<u4").tolist())), last)


def bpe_round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): whole texts encoded by the rank file's merges
    without special tokens, and the ids decoded again. A narrow map: no shuffle, one row per row."""

    def rows(source):
        cached, words = encoder(vocabulary, pattern)
        for group in grouped(source):
            state = [[0, hashlib.sha256(), hashlib.sha256(), Decoder(words)] for _ in group]

            def take(i, values):
                ids = b"".join(values)
                s = state[i]
                s[0] += len(ids) // 4
                s[1].update(ids)
                for at in range(0, len(ids), 4 * DECODE_IDS):
                    s[2].update(s[3].feed(ids[at:at + 4 * DECODE_IDS]).encode())

            cached.feed(((i, r["text"]) for i, r in enumerate(group)), take)
            for r, s in zip(group, state):
                s[2].update(s[3].feed(b"", True).encode())
                yield r["doc_id"], s[0], s[1].hexdigest(), s[2].hexdigest()

    return map_rows(texts_of(docs), rows, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the ids themselves, for users of the operator."""

    def rows(source):
        cached, _ = encoder(vocabulary, pattern)
        for group in grouped(source):
            out = [bytearray() for _ in group]
            cached.feed(((i, r["text"]) for i, r in enumerate(group)), lambda i, values: out[i].extend(b"".join(values)))
            for r, ids in zip(group, out):
                yield r["doc_id"], np.frombuffer(bytes(ids), "<u4").tolist()

    return map_rows(texts_of(docs), rows, "doc_id bigint, ids array<bigint>")
