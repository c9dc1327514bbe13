"""Packing of token pieces into sequences by linear grouping.

Lengths are at most the capacity, so their counts are a table of at most ``capacity`` rows: the plan
is made on that table alone, and its size doesn't depend on the number of documents. (1) Lengths
over ``SMALL`` are sorted and dealt into ``GROUPS`` groups of equal cardinality; each is rounded
up to its group's largest. (2) How often each configuration (a set of rounded sizes that fits) is
used is a linear program over all configurations, solved by column generation: a knapsack over the
sizes' prices finds the configuration that would save most, until it would save less than ``LEAST_GAIN``. A
solution has at most as many configurations as sizes.
(3) ``SHARE`` of each configuration's sequences are made, with actual lengths in place of the rounded
ones: in each place the longest that fits there, in the last one the longest that fits the room left. What
remains is grouped and solved anew, until no whole sequence comes out. (4) The rest (a few sequences) and
lengths up to ``SMALL`` go by falling length to the sequences where they fit best, new ones if none.
The plan says, for the r-th piece of each length, its sequence and offset; ranks are given by
salted counts, so no length (a third of all rows may share one) meets in one task.

Each round has at most ``GROUPS`` sizes; the number of rounds grows with the logarithm of the number of
pieces. The README has plans' sizes against the lower bound.

Defined cases: null or empty text: a document of the end id alone; repeated rows are packed each;
empty table: no rows; long texts are tokenised in blocks and cut into pieces of the capacity, the
first one shorter.
"""

from __future__ import annotations

import bisect
import json
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.common import map_rows, texts_of
from retention.llm.pieces import Cached
from retention.llm.token_counts import byte_chars, grouped
from retention.session import materialize

#: Groups of equal cardinality for the large lengths, and the largest length that is packed last.
GROUPS, SMALL = 64, 32
#: Part of a solution's sequences that a round makes before the rest is grouped again.
SHARE = 0.5
#: A configuration that would save less than this part of a sequence isn't added to a solution.
LEAST_GAIN = 1e-3
#: Parts of a length that are ranked apart from each other.
SALTS = 256


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Cached:
    """A worker's cached encoder of a byte-level ``tokenizers`` file: stretches to little-endian 32-bit ids.

    Most stretches are short, and the library spends most of its time on each call; the file's merges
    run three times faster in ``tiktoken``, whose ranks are then mapped to the file's ids. The tests
    hold the ids against the library's own.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec.get("normalizer") or model["type"] != "BPE":
        raise ValueError("not a plain byte-level BPE file")
    added = spec.get("added_tokens", [])
    if len(added) > 1:
        raise ValueError("more than one added token")
    to_byte = byte_chars()
    symbols = [*to_byte, *("".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])]
    ranks = {bytes(map(to_byte.__getitem__, t)): i for i, t in enumerate(symbols)}
    ids = [model["vocab"][t] for t in symbols]
    encode = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def resolve(stretches: list[str]) -> list[bytes]:
        return [array("I", map(ids.__getitem__, encode(s))).tobytes() for s in stretches]

    cached = Cached(None, resolve, b"".join, added[0]["content"] if added else None)
    cached.special_ids = array("I", [a["id"] for a in added]).tobytes()
    return cached


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the tokenised documents, cut where they are longer
    than ``capacity``; then the first piece takes the remainder."""
    end = np.array([end_id], "<u4").tobytes()

    def rows(source):
        encode = tokenizer(vocabulary)
        for group in grouped(source):
            out = [bytearray() for _ in group]
            encode.feed(((i, r["text"]) for i, r in enumerate(group)), lambda i, v: out[i].extend(encode.special_ids if v is None else b"".join(v)))
            for r, ids in zip(group, out):
                ids += end
                at, size = 0, len(ids) // 4
                stop = size % capacity or capacity
                piece = 0
                while at < size:
                    yield r["doc_id"], piece, at, stop - at, zlib.crc32(ids[4 * at:4 * stop])
                    at, stop, piece = stop, stop + capacity, piece + 1

    return map_rows(texts_of(docs), rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


class Plan:
    """Batches of equal sequences: ``add`` takes the lengths in one sequence with their counts."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left, self.capacity = dict(counts), capacity
        self.batches: list[list] = []  # [number of sequences, {length: times}]

    def room(self, batch: list) -> int:
        return self.capacity - sum(n * k for n, k in batch[1].items())

    def places(self) -> dict[int, tuple[list[int], list[tuple]]]:
        """For each length: the first ranks of its runs, and (first sequence, times, first offset)."""
        out: dict[int, tuple[list, list]] = {}
        used: dict[int, int] = {}
        first = 0
        for many, inside in self.batches:
            offset = 0
            for n in sorted(inside, reverse=True):
                froms, entries = out.setdefault(n, ([], []))
                froms.append(used.get(n, 0))
                entries.append((first, inside[n], offset))
                used[n] = used.get(n, 0) + many * inside[n]
                offset += n * inside[n]
            first += many
        return out


def rounded_groups(large: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Equal-cardinality groups of (length, count), from the longest; each a list of (length, count)."""
    total = sum(c for _, c in large)
    each = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = [[]]
    room = each
    for n, c in sorted(large, reverse=True):
        while c:
            take = min(c, room)
            out[-1].append((n, take))
            c, room = c - take, room - take
            if not room:
                out.append([])
                room = each
    return [g for g in out if g]


def best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is in the configuration whose prices sum highest: a knapsack over capacities."""
    worth, steps = np.zeros(capacity + 1), []
    for i, size in enumerate(sizes):
        for _ in range(capacity // size if prices[i] > 0 else 0):
            more = worth[:-size] + prices[i]
            better = more > worth[size:]
            if not better.any():
                break
            worth[size:][better] = more[better]
            steps.append((i, better))
    used, room = np.zeros(len(sizes)), capacity
    for i, better in reversed(steps):
        if room >= sizes[i] and better[room - sizes[i]]:
            used[i] += 1
            room -= sizes[i]
    return used


def configurations(demand: dict[int, int], capacity: int, least: float = LEAST_GAIN) -> list[tuple[dict[int, int], float]]:
    """(times each size is inside, fractional number of sequences): a solution of the linear program that
    covers the demand with the fewest sequences, up to the part ``least`` of them (the prices over the best worth
    are a bound). Starts from configurations of one size."""
    sizes = sorted(demand, reverse=True)
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    # unequal shares far below one sequence keep the pivots from running in a circle
    amount = np.array([demand[s] for s in sizes]) * (1 + 1e-9 * np.arange(n)) / basis.diagonal()
    while n:
        prices = np.linalg.solve(basis.T, np.ones(n))
        found = best_configuration(sizes, prices, capacity)
        if found @ prices <= 1 + least:
            break
        change = np.linalg.solve(basis, found)
        limit = np.divide(amount, change, out=np.full(n, np.inf), where=change > 1e-9)
        out = int(limit.argmin())
        step = limit[out]
        amount = np.maximum(amount - step * change, 0)
        amount[out] = step
        basis[:, out] = found
    return [({sizes[i]: int(k) for i, k in enumerate(column) if k}, float(x)) for column, x in zip(basis.T, amount)]


def make_plan(counts: dict[int, int], capacity: int = 1024, groups: int = GROUPS, small: int = SMALL) -> Plan:
    plan = Plan(counts, capacity)
    if full := counts.get(capacity):
        plan.batches.append([full, {capacity: 1}])
    left = _Left({n: c for n, c in counts.items() if small < n < capacity and c})
    made = True
    while made:
        demand: dict[int, int] = {}
        for g in rounded_groups(left.items(), groups):  # a frequent length may fill several groups
            demand[g[0][0]] = demand.get(g[0][0], 0) + sum(c for _, c in g)
        made = False
        for inside, many in configurations(demand, capacity):
            places = sorted((size for size, k in inside.items() for _ in range(k)), reverse=True)
            made |= _substitute(plan, left, places, int(many * SHARE))
    _best_fit(plan, [(n, c) for n, c in counts.items() if n <= small and c] + left.items())
    return plan


class _Left:
    """Counts of the lengths that have no place yet."""

    def __init__(self, counts: dict[int, int]):
        self.counts, self.lengths = counts, sorted(counts)

    def items(self) -> list[tuple[int, int]]:
        return [(n, c) for n, c in self.counts.items() if c]

    def longest(self, room: int, taken: dict[int, int]) -> int:
        """The longest length up to ``room`` of which more are left than are taken already; 0 if none."""
        at = bisect.bisect_right(self.lengths, room)
        while at:
            n = self.lengths[at - 1]
            if self.counts[n] > taken.get(n, 0):
                return n
            at -= 1
            if not self.counts[n]:
                del self.lengths[at]
        return 0


def _substitute(plan: Plan, left: _Left, places: list[int], times: int) -> bool:
    """Makes ``times`` sequences with actual lengths in a configuration's places, the longest that fits in
    each; the room of the last place and what is over goes to the longest that fit there."""
    made = False
    while times > 0:
        inside: dict[int, int] = {}
        room = plan.capacity
        for size in places[:-1]:
            if n := left.longest(size, inside):
                inside[n] = inside.get(n, 0) + 1
                room -= n
        while n := left.longest(room, inside):
            inside[n] = inside.get(n, 0) + 1
            room -= n
        if not inside:
            break
        many = min(times, *(left.counts[n] // k for n, k in inside.items()))
        for n, k in inside.items():
            left.counts[n] -= k * many
        plan.batches.append([many, inside])
        times -= many
        made = True
    return made


def _best_fit(plan: Plan, rest: list[tuple[int, int]]) -> None:
    """Lengths with counts, the longest first, to the sequences with the least room that holds them."""
    by_room: dict[int, list[list]] = {}
    for b in plan.batches:
        by_room.setdefault(plan.room(b), []).append(b)
    for n, c in sorted(rest, reverse=True):
        while c:
            room = next((r for r in range(n, plan.capacity) if by_room.get(r)), None)
            if room is None:
                batch, room = [-(-c // (plan.capacity // n)), {}], plan.capacity
                plan.batches.append(batch)
            else:
                batch = by_room[room].pop()
            each = min(room // n, c)
            many = min(batch[0], c // each)
            if many < batch[0]:
                rest = [batch[0] - many, dict(batch[1])]
                plan.batches.append(rest)
                by_room.setdefault(room, []).append(rest)
                batch[0] = many
            batch[1][n] = batch[1].get(n, 0) + each
            c -= many * each
            by_room.setdefault(room - n * each, []).append(batch)


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to (doc_id, piece, start, length, ids_crc32). ``pieces`` is read
    twice: pass a materialised frame."""
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id()).withColumn("_salt", F.col("_row") % SALTS)
    salted = numbered.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    # at most capacity x SALTS rows
    offsets = salted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    counts = {r["length"]: r["n"] for r in salted.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most capacity rows
    places = make_plan(counts, capacity).places()
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")) - 1
    ranked = numbered.withColumn("_rank", rank).join(offsets, ["length", "_salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_before")).alias("_rank"))

    def rows(source):
        for r in source:
            froms, entries = places[r["length"]]
            run = bisect.bisect_right(froms, r["_rank"]) - 1
            first, times, offset = entries[run]
            k = r["_rank"] - froms[run]
            yield r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], first + k // times, offset + k % times * r["length"]

    return map_rows(ranked, rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Packs all documents: a row per piece with its sequence and its offset there."""
    return pack(materialize(pieces_of(docs, vocabulary, end_id, capacity)), capacity)
