"""Source mixing, the prefix trie and phrase collocations against brute force, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from retention.llm import fm_index, mixing, phrases, prefix_trie
from retention.llm.ternary_trie import TernaryTree

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, size string, target string"


def fixed_point(sizes):
    """Targets by sharing the excess again and again, in fractions."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        open_ = sum(weight[s] for s in names if s not in stopped)
        share = {s: Fraction(3 * sizes[s]) if s in stopped else Fraction(left * weight[s], open_) for s in names}
        more = {s for s in names if share[s] > 3 * sizes[s]}
        if not more:
            return share
        stopped |= more


@pytest.fixture(scope="module")
def mixed_rows():
    r = random.Random(5)
    rows = [(i, " ".join("w" * r.randint(1, 3) for _ in range(int(r.paretovariate(0.9) * 3) % 3000)), "en", r.choice(["a", "a", "a", "b", "é", "日", None, "tiny"] if i % 40 else ["rare"]), "x", "y") for i in range(900)]
    rows += [(None, "no id", None, "a", None, None)] * 3 + [(7000, None, "en", "b", "x", "y"), (7001, "", "en", "empty", "x", "y"), (7002, " \x0b\t", "en", "empty", "x", "y")]
    rows += [(7003, "same row again", "en", "copies", "x", "y")] * 9000 + [(7004, "long " * 200_000, "en", "long", "x", "y")]
    return rows


def test_mix_meets_its_targets(spark, mixed_rows):
    docs = spark.createDataFrame(mixed_rows, DOCS)
    got = mixing.mix(docs).collect()
    words = re.compile(mixing.WORD)
    sizes, largest = Counter(), Counter()
    for r in mixed_rows:
        n = len(words.findall(r[1] or ""))
        sizes[r[3]] += n
        largest[r[3]] = max(largest[r[3]], n)
    want = fixed_point(sizes)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(words.findall(r[1] or ""))) for r in mixed_rows)
    source_of = {r[0]: r[3] for r in mixed_rows}
    taken = Counter()
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(want[s]), rel=1e-12)
        if r.size:
            rate = want[s] / sizes[s]
            assert r.taken % r.size == 0 and rate // 1 <= r.taken // r.size <= min(3, -(-rate // 1))
        else:
            assert r.taken == 0
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1.01 * largest[s], s


def test_mix_reruns_agree_under_any_partitioning(spark, mixed_rows):
    docs = spark.createDataFrame(mixed_rows[:950], DOCS)
    first = sorted(map(tuple, mixing.mix(docs.repartition(1)).collect()), key=str)
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(13)).collect()), key=str)


def test_mix_of_nothing_and_of_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(1, None, None, None, None, None), (2, " ", "en", "a", None, None)]
    assert sorted(tuple(r) for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_sources_are_ranked_by_code_point(spark):
    names = ["b", "a", None, "é", "Z", "", "日本", "\U0001f600", "￿"] + [f"s{i:03}" for i in range(100)]
    got = {r.source: r.w for r in mixing.weighted(spark.createDataFrame([(n, 1) for n in names], "source string, source_size bigint")).collect()}
    assert got == {s: i % 3 + 1 for i, s in enumerate(sorted(names, key=lambda s: (s is None, s or "")))}


def brute_phrases(rows):
    """(lang -> phrase -> count) of 1 to 4 words, and each language's first phrases, by the definitions."""
    counts = defaultdict(Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= 30}
        inside = defaultdict(int)
        for p, c in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], c)
        rows = []
        for p, a in cand.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, left, right, n, score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows[:2000])]
    return sorted(out)


def phrase_rows():
    r = random.Random(7)
    vocab = ["the", "The", "of", "a", "ÀB", "日本", "x\xa0y", "it's", "#", "\x00", "z\x1cz", "und"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(500):
        parts = []
        for _ in range(r.randint(0, 30)):
            parts.append(r.choice(["new york city hall", "ad hoc", "to be or not", " ".join(r.choices(vocab, k=r.randint(1, 6)))]))
            parts.append(r.choice([" ", "\t", "  ", ".", ",", ";\n", "\x0b", "\r", "\x0c", "! ", "?", ":"]))
        rows.append(("".join(parts), r.choice(["en", "en", "en", "de", None, "und", ""])))
    rows += [(None, "en"), ("", "en"), (" \t ", None), ("lone", "fr")] + [("same row of five words", "en")] * 40
    rows.append((" ".join(r.choices(vocab[:20], k=60_000)), "long"))
    return rows


def test_collocations_equal_brute_force(spark, monkeypatch):
    rows = phrase_rows()
    docs = spark.createDataFrame([(None if i % 50 == 0 else i, t, lang, "x", "y", "z") for i, (t, lang) in enumerate(rows)], DOCS)
    want = brute_phrases(rows)
    assert len({r[0] for r in want}) >= 4
    for parts, shard in ((1, phrases.SHARD_BYTES), (7, 4000)):
        monkeypatch.setattr(phrases, "SHARD_BYTES", shard)
        assert sorted(map(tuple, phrases.collocations(docs.repartition(parts)).collect())) == want
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_phrases_leave_shards_in_packed_parts(spark, monkeypatch):
    """Rows between the shards and the sums follow the shards, not the phrases that reach the least count."""
    import pyarrow as pa

    monkeypatch.setattr(phrases, "HELD_PHRASES", 50)
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, t, lang, "x", "y", "z") for i, (t, lang) in enumerate(rows)], DOCS)
    f = Counter()
    for t, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))):
            ws = re.findall(r"[^\x20\x09]+", piece)
            f.update(("und" if lang is None else lang, tuple(ws[i:i + k])) for k in range(1, 5) for i in range(len(ws) - k + 1))
    found = {(r.lang, r.phrase): r.f for r in phrases.frequent_phrases(docs.repartition(3)).where("words > 1").collect()}
    assert found == {(lang, " ".join(p)): n for (lang, p), n in f.items() if len(p) > 1 and n >= 30} and len(found) > 100
    data = bytes(range(256)) * 50 + b"\0"
    assert phrases.unpack(phrases.pack(data)) == data and len(phrases.pack(data)) < len(data) / 5 and phrases.unpack(phrases.pack(b"")) == b""
    every = phrases.Frequent()
    every.bits = {k: np.full(2 << phrases.BITS[max(k, 1)] >> 3, 255, np.uint8) for k in range(5)}
    assert phrases.part_count(every, 4) > 200
    fields = spark.createDataFrame([], phrases.PARTS).schema
    ids, words = phrases.word_ids([" ".join(f"w{i % 50}" for i in range(3000)).encode()])
    shard = pa.RecordBatch.from_arrays([pa.array([x]) for x in ("en", phrases.pack(b"\n".join(words)), phrases.pack(ids.tobytes()))], names=["lang", "words", "ids"])
    made = list(phrases._phrases_of(fields, type("Held", (), {"value": every}), 3)([shard]))
    assert sum(b.num_rows for b in made) <= 1 + 4 * 3


def test_collocations_keep_the_first_of_each_language(spark):
    docs = spark.createDataFrame([(i, t, lang, None, None, None) for i, (t, lang) in enumerate(phrase_rows())], DOCS)
    want = [r for r in brute_phrases(phrase_rows()) if r[1] <= 5]
    assert sorted(map(tuple, phrases.collocations(docs, top=5).collect())) == want


def test_index_extends_both_ways():
    """Every pattern's interval begins where its suffixes do, in the index and in the reversed one."""
    r = np.random.default_rng(3)
    x = np.append(r.integers(0, 5, 700), 0).astype(np.int32)
    index = fm_index.Bidirectional(x, 4)
    text = x.tolist()
    for k, found in enumerate(index.grams(4), start=2):
        grams = Counter(tuple(text[i:i + k]) for i in range(len(text) - k + 1) if 0 not in text[i:i + k])
        got = {tuple(int(c) for c in p): int(n) for *p, n in zip(*found.words, found.count)}
        assert got == grams
        for t, low in ((text, found.low), (text[::-1], found.low_back)):
            starts = sorted((t + t)[i:i + k] for i in range(len(t)))
            for p, at in zip(zip(*found.words), low):
                p = [int(c) for c in p]
                assert starts.index(p if t is text else p[::-1]) == at


TURNS = "conv_id bigint, turn bigint, role string, text string, ends string, key string"


def brute_trie(rows):
    """The contract's rows, prefix by prefix. ``rows`` are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
          hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=str)


def trie_rows():
    r = random.Random(11)
    texts = ["", "hello", "日本語", "\x00", "a:b", "hello", None, "x" * 5000]
    rows = []
    for c in [*range(0, 260), 1000, 1001, 1100, 99_999_999_999]:
        for turn in range(r.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, r.choice(["user", "assistant", None]), r.choice(texts)))
    for c in range(300, 400):  # one conversation that many have
        rows += [(c, t, "user", f"same {t}") for t in range(6)]
    rows += [(500 + i, t, "user", "deep" if t < 300 else f"{i % 3}") for i in range(4) for t in range(400)]
    rows += [(700, None, "user", "null turn"), (700, None, "user", "null turn"), (700, 3, "a", "tie"), (700, 3, "b", "tie"), (700, 3, "a", "other")]
    return [*rows, (None, 1, "user", "no conversation"), (None, None, None, None), rows[5], rows[5]]


def test_trie_equals_brute_force_in_any_shards(spark, monkeypatch):
    rows = trie_rows()
    turns = spark.createDataFrame([(*x, "a", "b") for x in rows], TURNS)
    want = brute_trie(rows)
    for size in (prefix_trie.SHARD_TURNS, 25):
        monkeypatch.setattr(prefix_trie, "SHARD_TURNS", size)
        got = prefix_trie.conversation_trie(turns.repartition(5))
        assert got.columns == prefix_trie.OUT
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert prefix_trie.conversation_trie(turns.limit(0)).collect() == []


def test_trie_of_turnless_conversations(spark):
    """All of 1's turns may give way to those of a conversation that isn't there."""
    bare = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1][:3]
    rows = [(c, 0, "user", "hi") for c in bare]
    got = [tuple(r) for r in prefix_trie.conversation_trie(spark.createDataFrame([(*x, "", "") for x in rows], TURNS)).collect()]
    assert got == [(bare[0], 0, None, 3, 0, 1, 0, hashlib.sha256(",".join(map(str, bare)).encode()).hexdigest())]


def test_tree_by_medians_is_balanced():
    rows = [((i, 1), (1, 1), 1, i, None) for i in range(1023)]
    tree = TernaryTree()
    assert [tree.depth[n] for n in tree.insert_sorted(rows)] == [2] * 1023
    deepest, stack = 0, [(tree.first[0], 1)]
    while stack:
        node, d = stack.pop()
        if node:
            deepest = max(deepest, d)
            stack += [(tree.smaller[node], d + 1), (tree.larger[node], d + 1)]
    assert deepest == 10 and len(tree.order()) == 2047
