"""Each operator against the library or a brute-force version, and its defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from retention.llm import bpe_fst, catalog, chat, ctph, packing, simhash, token_counts, warc

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, n_tokens string, score string, fingerprint string"
PARTS = [" ", "  ", "\n", " \n", "\t", "a", "b", "the", "ing", "'s", "1", "22", "!", "...", "\x1c", "\x85", "\xa0", "é", "日本", "😀", "\x00", "a" * 50, "<|endoftext|>", "\r\n", "　"]


def odd_texts():
    r = random.Random(1)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 60))) for _ in range(120)] + ["", " ", "a" * 3000, " x" * 3000, None, "Repeated. Row", "Repeated. Row"]


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls, odd white space, repeated rows and columns whose names clash with results."""
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, rows[-1], (None, "no id", None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def hf():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(catalog._vocabulary("byte_bpe_50k.json"))


def test_token_counts_equal_the_library(spark, odd, empty, hf):
    for docs in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        got = sorted(map(tuple, token_counts.token_counts(docs, catalog._vocabulary("byte_bpe_50k.json"), catalog._pattern()).collect()), key=str)
        want = []
        for r in docs.collect():
            n = len(hf.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
        assert got == sorted(want, key=str)
    assert token_counts.token_counts(empty, catalog._vocabulary("byte_bpe_50k.json"), catalog._pattern()).count() == 0


def test_transducer_equals_the_library_and_decodes(spark, odd, empty):
    import tiktoken

    path, pattern = catalog._vocabulary("byte_bpe_50k.tiktoken"), catalog._pattern()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe_fst.load_ranks(path), special_tokens={})
    for docs in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        got = sorted(map(tuple, bpe_fst.bpe_round_trip(docs, path, pattern).collect()), key=str)
        want = []
        for r in docs.collect():
            ids = library.encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert got == sorted(want, key=str)
    assert bpe_fst.bpe_round_trip(empty, path, pattern).count() == 0


def test_decoder_carries_split_characters():
    words = [bytes([i]) for i in range(256)]
    state = bpe_fst.Decoder(words)
    out = [state.feed(np.array([b], "<u4").tobytes()) for b in "aé日😀".encode()]
    assert "".join(out) == "aé日😀" and out[1] == ""
    assert state.feed(np.array([0xE6], "<u4").tobytes()) == "" and state.feed(b"", True) == "�"


def packed_right(rows, texts, hf, capacity=1024):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids = [*hf.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids) and all(p.length == capacity for p in pieces[1:])
    assert not by_doc
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_packing(spark, odd, empty, hf):
    path = catalog._vocabulary("byte_bpe_50k.json")
    for docs in (odd.where("doc_id is not null").dropDuplicates(["doc_id"]), spark.read.parquet(f"{SMALL}/documents.parquet")):
        rows = packing.pack_documents(docs, path).collect()
        n = packed_right(rows, {r.doc_id: r.text for r in docs.collect()}, hf)
        assert n <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1
    assert packing.pack_documents(odd, path).where("doc_id is null").count() == 1
    assert packing.pack_documents(empty, path).count() == 0


def test_packing_plan_keeps_every_item():
    r = random.Random(2)
    for lengths in ([r.randint(1, 1024) for _ in range(3000)], [700, 400, 300, 5], [1024] * 3, [1] * 2000, [513] * 10 + [511] * 10, []):
        counts = {n: lengths.count(n) for n in set(lengths)}
        got = {}
        plan = packing.make_plan(counts)
        for many, inside in plan.batches:
            assert many > 0 and sum(n * k for n, k in inside.items()) <= 1024
            for n, k in inside.items():
                got[n] = got.get(n, 0) + many * k
        assert got == counts
        bins = sum(m for m, _ in plan.batches)
        assert bins <= -(-sum(lengths) // 1024) * 1.01 + 2 or lengths == [513] * 10 + [511] * 10 and bins == 10 or len(lengths) == 4


def test_configurations_are_optimal():
    """The solution covers the demand, and prices under which no configuration is worth more than one sequence
    have its total: no other solution of the program has fewer sequences."""
    r = random.Random(3)
    for _ in range(5):
        demand = {n: r.randint(1, 500) for n in r.sample(range(20, 100), 8)}
        solution = packing.configurations(demand, 100, 1e-7)
        sizes = sorted(demand, reverse=True)
        for n in sizes:
            assert sum(inside.get(n, 0) * x for inside, x in solution) == pytest.approx(demand[n], rel=1e-6)
        assert all(sum(n * k for n, k in inside.items()) <= 100 for inside, _ in solution)
        basis = np.array([[inside.get(n, 0) for n in sizes] for inside, _ in solution], float)
        prices = np.linalg.solve(basis, np.ones(len(sizes)))

        def most(at, room):
            return 0.0 if at == len(sizes) else max(k * prices[at] + most(at + 1, room - k * sizes[at]) for k in range(room // sizes[at] + 1))

        assert most(0, 100) <= 1 + 1e-6
        assert sum(x for _, x in solution) == pytest.approx(sum(demand[n] * p for n, p in zip(sizes, prices)), rel=1e-6)
    assert packing.configurations({}, 100) == []


def test_packing_rounds_to_few_sizes(monkeypatch):
    """Each round solves for at most GROUPS sizes; the plan beats best fit where that is bad."""
    seen = []
    solve = packing.configurations
    monkeypatch.setattr(packing, "configurations", lambda demand, capacity: seen.append(len(demand)) or solve(demand, capacity))
    lengths = np.random.default_rng(5).integers(129, 500, 200_000)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    plan = packing.make_plan(counts)
    assert packing.GROUPS <= 64 and max(seen) <= packing.GROUPS < len(counts)
    simple = packing.Plan(counts, 1024)
    packing._best_fit(simple, list(counts.items()))
    bound = -(-int(lengths.sum()) // 1024)
    assert sum(m for m, _ in plan.batches) <= 1.003 * bound < 1.02 * bound < sum(m for m, _ in simple.batches)


def test_simhash_equals_brute_force(spark, odd, empty):
    import xxhash

    def mark(text):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for docs in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        rows = [(r.doc_id, mark(r.text)) for r in docs.select("doc_id", "text").collect()]
        root = list(range(len(rows)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i, (_, x) in enumerate(rows):
            for j in range(i):
                if (x ^ rows[j][1]).bit_count() <= 2:
                    root[find(i)] = find(j)
        least = {}
        for i, (d, _) in enumerate(rows):
            if d is not None:
                least[find(i)] = min(d, least.get(find(i), d))
        want = sorted(((d, f"{x:016x}", least.get(find(i))) for i, (d, x) in enumerate(rows)), key=str)
        assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("crowded", [48, 2])
def test_simhash_links_of_dense_groups(spark, monkeypatch, crowded):
    from retention.llm.graph import components

    monkeypatch.setattr(simhash, "CROWDED", crowded)
    r = random.Random(5)
    centre = [r.getrandbits(64) for _ in range(4)]
    fps = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for c in centre for _ in range(60)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    want = {f: f for f in fps}
    changed = True
    near = [(x, y) for i, x in enumerate(fps) for y in fps[:i] if ((x ^ y) & (2**64 - 1)).bit_count() <= 2]
    while changed:
        changed = False
        for x, y in near:
            m = min(want[x], want[y])
            changed |= want[x] != m or want[y] != m
            want[x] = want[y] = m
    got = {f: f for f in fps} | {row.node: row.root for row in components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"))).collect()}
    assert got == want


def test_word_blocks_join_to_the_text(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r = random.Random(3)
    for _ in range(50):
        data = "".join(r.choice(["ab", " ", "\n", "x" * 30, "\x0b"]) for _ in range(60)).encode()
        assert [w for b in simhash.word_blocks(data) for w in b] == data.split()


@pytest.mark.parametrize("many", [1_000, 1])
def test_archive_round_trip(spark, monkeypatch, many):
    monkeypatch.setattr(warc, "MANY_COPIES", many)
    shared = "<p>" + "é" * 80
    pages = spark.createDataFrame([(5, "http://a/\r\nX: y", shared, "x"), (3, None, shared, "x"), (9, "u", "tiny", "x"), (8, "u", "tiny", "x"), (7, "u", None, "x"), (None, "u", shared, "x"), (3, "again", shared, "x"), (11, "u", "\r\n\r\nWARC-Type: response\r\n" + "z" * 100, "x")], "page_id bigint, url string, html string, payload string")
    rows = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages).collect()}
    d = lambda s: hashlib.sha256(s.encode()).hexdigest()
    long_ = "\r\n\r\nWARC-Type: response\r\n" + "z" * 100
    assert rows == {(5, 163, d(shared), "revisit", 3), (3, 163, d(shared), "response", None), (None, 163, d(shared), "revisit", 3), (9, 4, d("tiny"), "response", None), (8, 4, d("tiny"), "response", None), (7, 0, d(""), "response", None), (11, len(long_), d(long_), "response", None)}
    assert warc.archive_round_trip(pages).count() == 8
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_damaged_payload_is_an_error(spark):
    from pyspark.sql import functions as F

    from retention.session import scratch_path

    pages = spark.createDataFrame([(1, "u", "x" * 200)], "page_id bigint, url string, html string")
    archive = warc.write_archive(pages, scratch_path(spark, "warc-test"))
    record = warc.record_bytes(warc.read_archive(spark, archive)).first().record
    head, _, body = bytes(record).partition(b"\r\n\r\n")
    assert body == b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 200\r\n\r\n" + b"x" * 200 + b"\r\n\r\n"
    assert f"Content-Length: {len(body) - 4}".encode() in head
    bad = scratch_path(spark, "warc-bad")
    spark.read.parquet(archive.payloads).withColumn("payload", F.lit(b"y" * 200)).write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, warc.Archive(archive.records, bad)).collect()


def test_fingerprints_of_edited_texts(spark, odd, empty):
    for docs in (odd.where("doc_id is not null").dropDuplicates(["doc_id"]), spark.read.parquet(f"{SMALL}/documents.parquet"), odd.where("doc_id = 3")):
        rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
        got = {r.doc_id: r for r in ctph.edited_fingerprints(docs).collect()}
        assert len(got) == len(rows)
        for i, (d, text) in enumerate(rows):
            after = rows[(i + 1) % len(rows)][1]
            n = len(text)
            edited = text[:n - n // 2] + after[:n // 2]
            r = got[d]
            assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
            assert r.fingerprint == ctph.fingerprint(text) and r.edited_fingerprint == ctph.fingerprint(edited)
            near = ctph.likeness([(r.fingerprint, r.edited_fingerprint), (r.fingerprint, ctph.fingerprint(after))])
            assert [r.near_edited, r.near_next] == near and all(0 <= x <= 1 for x in near)
    assert ctph.edited_fingerprints(odd).count() == odd.count()
    assert ctph.edited_fingerprints(empty).count() == 0


def test_likeness_is_one_less_the_edit_distance():
    r = random.Random(4)

    def distance(a, b):
        rows = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(rows[j - 1] if x == y else 1 + min(rows[j], new[-1]))
            rows = new
        return rows[-1]

    letters = ["AA", "AB", "BA", "//"]
    pairs = [("".join(r.choices(letters, k=r.randint(1, 64))), "".join(r.choices(letters, k=r.randint(1, 64)))) for _ in range(60)]
    want = [1 - distance(ctph._symbols(a), ctph._symbols(b)) / (len(a) + len(b)) * 2 for a, b in pairs]
    assert np.allclose(ctph._likeness(pairs), want)


def test_fingerprint_blocks_and_sizes(monkeypatch):
    r = random.Random(6)
    text = "".join(r.choice("abcdefgh ") for _ in range(50_000))
    whole = ctph.fingerprint(text)
    monkeypatch.setattr(ctph, "BLOCK", 999)
    assert ctph.fingerprint(text) == whole
    k, a, b = whole.split(":")
    assert 16 <= len(a) // 2 <= 64 and len(b) <= len(a)
    assert ctph.likeness([(whole, ctph.fingerprint(text[:-200] + "changed"))])[0] > 0.9
    assert ctph.likeness([(whole, ctph.fingerprint("".join(r.choice("abcdefgh ") for _ in range(50_000))))])[0] < 0.2
    assert ctph.likeness([("0::", "0::"), ("0::", whole)]) == [1.0, 0.0]


def digests(turns):
    said = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    loss = "".join(text or "" for role, text in turns if role == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(said), len(loss), sha(loss)


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "\\h # \\ </turn>\n### user: x"), (1, 2, "assistant", None), (2, 0, None, "né"), (2, 0, None, "né"), (None, 5, "a: b", "</turn"), (3, 1, "assistant", "b"), (3, None, "user", "a" * 5000)]
    rows += [(4, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(70)]
    got = {r.conv_id: r for r in chat.chat_digests(spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")).collect()}
    by = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role, text))
    assert {c: tuple(r)[1:5] for c, r in got.items()} == {c: digests(t) for c, t in by.items()}
    assert chat.chat_digests(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_best_paths_of_a_tree(spark):
    r = random.Random(7)
    nodes = [(0, None, 1.0)] + [(i, r.randrange(i), r.choice([0.0, 1.0, 2.0])) for i in range(1, 40)] + [(100, 999, 5.0)]
    trees = spark.createDataFrame([(1, i, p, "user", f"m{i}", s) for i, p, s in nodes] + [(1, 0, None, "user", "m0", 1.0)], "tree_id bigint, message_id bigint, parent_id bigint, role string, text string, score double")
    parent, score = {i: p if p != 999 else None for i, p, _ in nodes}, {i: s for i, _, s in nodes}
    paths = []
    for leaf in set(parent) - set(parent.values()):
        path, at = [], leaf
        while at is not None:
            path.append(at)
            at = parent[at]
        paths.append((-sum(score[x] for x in path) / len(path), -len(path), leaf, path[::-1]))
    want = [p[3] for p in sorted(paths)[:5]]
    got = {}
    for row in chat.best_paths(trees, 5).orderBy("path_rank", "position").collect():
        got.setdefault(row.path_rank, []).append(int(row.text[1:]))
    assert [got[k] for k in sorted(got)] == want


def test_reply_circle_is_an_error(spark):
    trees = spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)], "tree_id bigint, message_id bigint, parent_id bigint, role string, text string, score double")
    with pytest.raises(ValueError, match="circle"):
        chat.best_paths(trees)
