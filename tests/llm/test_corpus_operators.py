"""Quality rules, line and near dedup, the language model and the pipeline, against brute force."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retention.llm import catalog, gru, line_dedup, quality_mcd, recurrent_lm, simhash
from tests.llm.test_text_operators import packed_right

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
BLANK = " \t\n\x0b\x0c\r"


def edit_distance(a, b):
    rows = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(rows[j] + 1, new[-1] + 1, rows[j - 1] + (x != y)))
        rows = new
    return rows[-1]


def edited(r, s, k):
    s = list(s)
    for _ in range(k):
        i = r.randrange(len(s))
        kind = r.choice("sid")
        if kind == "s":
            s[i] = r.choice("abcé")
        elif kind == "i":
            s.insert(i, r.choice("abcé"))
        else:
            del s[i]
    return "".join(s)


# quality rules


def words_in(text):
    return [w for w in "".join(" " if c in BLANK else c for c in text).split(" ") if w]


def base_statistics(text):
    text = text or ""
    w = words_in(text)
    lines = [x for x in text.split("\n") if words_in(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_statistics_equal_brute_force(spark):
    r = random.Random(1)
    texts = [None, "", " \n\x0b ", "a b c a b c", "x\xa0y z #|<", "a b c d a b c a b c d\na b c d\n\na b c d"]
    texts += ["".join(r.choice(["aa", "b", "é", " ", "\n", "\t", "\x0c", "\x1c", "#", "a b c "]) for _ in range(r.randint(0, 400))) for _ in range(60)]
    rows = [(i, t, "en", None, "clash") for i, t in enumerate(texts)] + [(0, None, None, "s", "clash")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_words string")
    for frame in (docs, spark.read.parquet(f"{SMALL}/documents.parquet")):
        want = sorted(((x.doc_id, *base_statistics(x.text)) for x in frame.collect()), key=str)
        got = quality_mcd.quality_rows(frame).collect()
        assert sorted((tuple(x)[:7] for x in got), key=str) == want
        assert all(not x.kept for x in got if x.base_failed)
    assert quality_mcd.quality_rows(docs.limit(0)).count() == 0


def test_outliers_of_a_group_go_and_the_others_stay(spark):
    r = random.Random(2)

    def clean():
        return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(r.randint(80, 400)))

    rows = [(i, clean(), "en", "s" if i % 3 else "t", i) for i in range(450)]
    rows += [(1000 + i, " ".join(w + "###" for w in clean().split(" ")), "en", "s", i) for i in range(30)]
    rows += [(2000 + i, " ".join(w + "%%%" for w in clean().split(" ")), "xx", "few", i) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, _doc bigint")
    kept = {x.doc_id for x in quality_mcd.kept_documents(docs).select("doc_id").collect()}
    assert not kept & set(range(1000, 1030))
    assert set(range(450)) <= kept
    assert set(range(2000, 2005)) <= kept  # too few of their own and of all small groups to judge
    assert quality_mcd.kept_documents(docs).columns == docs.columns


def test_each_feature_rejects_on_its_own(spark):
    r = random.Random(12)

    def words(n, low=2, high=8):
        return ["".join(r.choices("abcdefghij", k=r.randint(low, high))) for _ in range(n)]

    rows = [(i, "\n".join(" ".join(words(10)) for _ in range(r.randint(8, 40)))) for i in range(400)]
    phrase = words(3, 6, 8)
    planted = {
        "x_words": " ".join(words(20_000)),
        "x_length": " ".join(words(200, 11, 14)),
        "x_symbols": " ".join(w + "#" * (i % 2) * 3 for i, w in enumerate(words(200))),
        "x_repeats": " ".join(x for i in range(30) for x in phrase + words(4)),  # 90 of 210 words
        "x_lines": "\n".join(x for w in words(100) for x in (w, "abcde")),
    }
    rows += [(1000 + i, t) for i, t in enumerate(planted.values())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source")
    judged = {x.doc_id: x for x in quality_mcd.judged(docs).collect()}
    for i, name in enumerate(planted):
        x = judged[1000 + i]
        assert not x.base_failed and not x.kept, (name, x.distance)
    assert all(judged[i].kept for i in range(400))


def steps_in_numpy(data, mean, cov):
    """Concentration steps from a start until the determinant stays: (log determinant, mean, covariance)."""
    floors = np.diag([quality_mcd.FLOOR[f] ** 2 for f in quality_mcd.FEATURES])
    h, before = int(np.ceil(len(data) * quality_mcd.SUPPORT)), np.inf
    while True:
        x = data - mean
        own = data[np.argsort(np.einsum("ij,jk,ik->i", x, np.linalg.inv(cov), x))[:h]]
        new = own.mean(axis=0), np.cov(own.T, bias=True) * quality_mcd.CONSISTENCY + floors
        det = np.linalg.slogdet(new[1])[1]
        assert det <= before + 1e-9
        if det > before - 1e-9:
            return det, mean, cov
        before, (mean, cov) = det, new


def test_estimate_equals_numpy(spark):
    """Two groups with far rows; the determinant isn't above that of numpy's steps from the classical, the median
    and many random starts, and the same rows lie beyond the cutoff."""
    r = np.random.default_rng(3)
    groups = {}
    for key, far in (("k", 0.0), ("m", 0.2)):
        data = r.normal(size=(400, 5)) @ r.normal(size=(5, 5)) * [1, 0.2, 0.1, 0.2, 0.2]
        data[:int(400 * far)] = data[:int(400 * far)] * 0.2 + [9, 2, 1, 2, -2]
        groups[key] = data
    rows = spark.createDataFrame([(k, *map(float, x)) for k, data in groups.items() for x in data], "_key string, " + ", ".join(f"{f} double" for f in quality_mcd.FEATURES))
    got = {x["_key"]: x for x in quality_mcd.estimated(rows, True).collect()}
    floors = np.diag([quality_mcd.FLOOR[f] ** 2 for f in quality_mcd.FEATURES])
    for key, data in groups.items():
        starts = [(data.mean(axis=0), np.cov(data.T) + floors), (np.median(data, axis=0), np.diag(data.var(axis=0)))]
        for _ in range(50):
            some = data[r.choice(400, 6, replace=False)]
            starts.append((some.mean(axis=0), np.cov(some.T) + floors))
        det, mean, cov = min((steps_in_numpy(data, *s) for s in starts), key=lambda x: x[0])
        x = got[key]
        assert x["_n"] == 400 and x["_det"] == pytest.approx(det, abs=0.02)
        w = np.array([[x[f"w_{a}_{b}"] if j <= i else 0.0 for j, b in enumerate(quality_mcd.FEATURES)] for i, a in enumerate(quality_mcd.FEATURES)])
        m = np.array([x[f"m_{f}"] for f in quality_mcd.FEATURES])
        assert x["_det"] == pytest.approx(-2 * np.log(w.diagonal()).sum())
        d2 = (((data - m) @ w.T) ** 2).sum(axis=1)
        want = np.einsum("ij,jk,ik->i", data - mean, np.linalg.inv(cov), data - mean)
        assert ((d2 > quality_mcd.CUTOFF) == (want > quality_mcd.CUTOFF)).all()
        assert (want > quality_mcd.CUTOFF).sum() >= (80 if key == "m" else 0)


# line dedup


def test_bounded_edit_distance(spark):
    r = random.Random(4)
    rows = [("", "", True), ("", "ab", True), ("", "abc", False), ("a" * 40, "a" * 42, True)]
    for _ in range(300):
        a = "".join(r.choice("abcdé ") for _ in range(r.randint(7, 60)))
        b = edited(r, a, r.randint(0, 4))
        rows.append((a, b, edit_distance(a, b) <= line_dedup.EDITS))
    frame = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert frame.withColumn("got", line_dedup.within(F.col("a"), F.col("b"))).where("not (got <=> want)").count() == 0


def some_lines(r):
    base = ["".join(r.choice("abcdefghij ") for _ in range(r.randint(32, 60))).strip().ljust(32, "x") for _ in range(40)]
    lines = {x for b in base for x in [b] + [edited(r, b, r.randint(1, 3)) for _ in range(5)]} | {edited(r, base[0], r.randint(1, 4)) for _ in range(100)}
    return sorted(x for x in {y.strip() for y in lines} if len(x) >= 32), base


@pytest.mark.parametrize("crowded", [64, 4])
def test_candidates_hold_every_near_pair(spark, monkeypatch, crowded):
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    lines, _ = some_lines(random.Random(5))
    want = {(j, i) for i, x in enumerate(lines) for j in range(i) if abs(len(x) - len(lines[j])) <= 2 and edit_distance(x, lines[j]) <= 2}
    got = {(min(p), max(p)) for p in line_dedup.candidates(spark.createDataFrame(list(enumerate(lines)), "id bigint, x string")).collect()}
    assert want <= got and len(want) > 100


@pytest.mark.parametrize("sampled", [64, 1])
def test_lines_of_one_template_do_not_emit_all_pairs(spark, monkeypatch, sampled):
    """Far fewer candidates than pairs, and every near pair's lines in one component of the true links;
    with frequent keys counted, and spread."""
    monkeypatch.setattr(line_dedup, "SAMPLED", sampled)
    r = random.Random(13)
    ids = sorted({"".join(r.choices("0123456789", k=10)) for _ in range(1500)} | {f"77777{k:05d}" for k in range(100)})
    lines = [f"see the page number {x} of our list" for x in ids]
    got = [tuple(p) for p in line_dedup.candidates(spark.createDataFrame(list(enumerate(lines)), "id bigint, x string")).collect()]
    assert len(got) < len(lines) ** 2 / 20
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in got:
        if find(a) != find(b) and edit_distance(ids[a], ids[b]) <= 2:
            root[find(a)] = find(b)
    blanked, deleted = {}, {}
    for i, x in enumerate(ids):
        for j in range(10):
            deleted.setdefault(x[:j] + x[j + 1:], []).append(i)
            for k in range(j):
                blanked.setdefault(x[:k] + "_" + x[k + 1:j] + "_" + x[j + 1:], []).append(i)
    assert all(find(i) == find(same[0]) for group in (blanked, deleted) for same in group.values() for i in same)


@pytest.mark.parametrize("crowded", [32, 4])
def test_links_of_a_group_are_fewer_than_its_lines(spark, monkeypatch, crowded):
    """Near lines are joined by rows in proportion to the lines, whatever their number of near pairs."""
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    r = random.Random(21)
    base = ["".join(r.choice("abcdefghij ") for _ in range(40)).strip().ljust(40, "x") for _ in range(6)]
    lines = sorted({b[:20] + c + b[20:] for b in base for c in "abcdefghijklmnopqrstuvwxy"} | {edited(r, base[0], r.randint(1, 4)).strip().ljust(34, "y") for _ in range(60)})
    frame = spark.createDataFrame(list(enumerate(lines)), "id bigint, x string")
    grouped = line_dedup.groups(frame, lambda ids: frame.join(ids, "id", "left_semi"))
    members = grouped.distinct().collect()
    got = [tuple(p) for p in line_dedup.linked(grouped, frame.withColumn("counts", line_dedup.class_counts(F.col("x")))).collect()]
    near = [(i, j) for i, x in enumerate(lines) for j in range(i) if abs(len(x) - len(lines[j])) <= 2 and edit_distance(x, lines[j]) <= 2]
    assert all((max(p), min(p)) in set(near) for p in got) and len(got) < len(members) and len(near) > 1500

    def components(pairs):
        root = list(range(len(lines)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(lines))]

    assert components(got) == components(near)


def test_few_keys_a_line(spark, monkeypatch):
    """A line is cut by one base, near the next one by two: four keys for each; crowded, by all but two segments."""
    r = random.Random(33)
    lines = ["".join(r.choices("abcdefghij ", k=n)).strip().ljust(32, "x") for n in range(32, 232) for _ in range(2)]
    lines += ["the beginning of a hundred lines and more" + "".join(r.choices("abcdefghij", k=54)) for _ in range(100)]
    made = []
    for name in ("_shared", "_met"):
        monkeypatch.setattr(line_dedup, name, lambda keyed, *a, f=getattr(line_dedup, name): made.append((keyed.select("id").distinct().count(), keyed.count())) or f(keyed, *a))
    frame = spark.createDataFrame(list(enumerate(lines)), "id bigint, x string")
    line_dedup.groups(frame, lambda ids: frame.join(ids, "id", "left_semi"))
    (n, keys), (crowded, fine) = made[0], made[-1]
    assert n == len(lines) and keys <= 6 * n
    assert crowded >= 100 and fine <= 20 * crowded


@pytest.mark.parametrize("inserted", [0, 1, 2])
def test_near_lines_whose_windows_end_in_other_rounds(spark, monkeypatch, inserted):
    """Of two near lines under a crowded key, the windows of one have SHORT code points, those of the other more."""
    monkeypatch.setattr(line_dedup, "CROWDED", 0)  # every key that two lines share is cut again
    r = random.Random(34)
    lines = []
    for n in range(32, 80):
        a = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=n))
        b = list(a)
        i, j = sorted(r.sample(range(n), 2))
        b[j:j + 1 - (inserted > 0)] = "0"
        b[i:i + 1 - (inserted > 1)] = "1"
        lines += [a, "".join(b)]
    frame = spark.createDataFrame(list(enumerate(lines)), "id bigint, x string")
    grouped = line_dedup.groups(frame, lambda ids: frame.join(ids, "id", "left_semi"))
    got = line_dedup.linked(grouped, frame.withColumn("counts", line_dedup.class_counts(F.col("x")))).collect()
    assert {(min(p), max(p)) for p in got} == {(k, k + 1) for k in range(0, len(lines), 2)}


def removed_by_brute_force(docs):
    every = [((d[0] is not None, d[0] or 0), k, p, x.strip(" ")) for k, d in enumerate(docs) if d[1] is not None for p, x in enumerate(d[1].split("\n")) if len(x.strip(" ")) >= 32]
    every.sort()
    first, root = {}, {}
    for o in every:
        first.setdefault(o[3], o)
    for x in first:
        root[x] = x

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = list(first)
    for i, x in enumerate(names):
        for y in names[:i]:
            if abs(len(x) - len(y)) <= 2 and edit_distance(x, y) <= 2:
                a, b = find(x), find(y)
                if a != b:
                    root[max(a, b, key=first.get)] = min(a, b, key=first.get)
    gone = {}
    for o in every:
        if first[find(o[3])] != o:
            gone.setdefault(o[1], []).append(o[2])
    return gone


def test_line_report_and_texts(spark):
    r = random.Random(6)
    lines, base = some_lines(r)
    docs = [(k, "\n".join(r.choice(lines) if r.random() < 0.5 else edited(r, r.choice(base), r.randint(0, 5)) for _ in range(r.randint(0, 5))), 9, "z") for k in range(80)]
    docs += [(150, None, None, "z"), (None, "x" * 40, 1, "z"), (None, "x" * 40, 1, "z"), (151, "", 0, "z"), (3, docs[3][1], 9, "z"), (152, "short\nshort\n\nshort", 1, "z"), (153, "  " + lines[0] + " \n" + lines[0], 1, "z")]
    gone = removed_by_brute_force(docs)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, n_chars bigint, removed string").coalesce(1)
    want = sorted(((d[0], len((d[1] or "").split("\n")), tuple(gone.get(k, []))) for k, d in enumerate(docs)), key=str)
    got = line_dedup.line_report(frame).collect()
    assert sorted(((x.doc_id, x.n_lines, tuple(x.removed)) for x in got), key=str) == want
    assert all(x.n_exact + x.n_near == len(x.removed) for x in got) and any(x.n_near for x in got)
    left = sorted(((d[0], None if d[1] is None else "\n".join(x for p, x in enumerate(d[1].split("\n")) if p not in gone.get(k, [])), d[3]) for k, d in enumerate(docs)), key=str)
    out = line_dedup.remove_lines(frame)
    assert out.columns == frame.columns
    assert sorted(((x.doc_id, x.text, x.removed) for x in out.collect()), key=str) == left
    assert line_dedup.line_report(frame.limit(0)).count() == 0


# near dedup


def test_one_document_of_each_fingerprint_component_stays(spark):
    r = random.Random(8)
    vocabulary = ["".join(r.choices("abcdefgh", k=5)) for _ in range(3000)]
    base = [" ".join(r.choices(vocabulary, k=r.choice([2, 6, 40, 400]))) for _ in range(50)]
    texts = base + [b.upper() for b in base[:20]] + [b + " more" for b in base] + [f"{b} {k}" for b in base[-12:] for k in range(4)]
    texts += ["", None, " \n", "one", "One ", "x" * 300_000 + " y", "word " * 200_000]
    order = list(range(len(texts)))
    r.shuffle(order)
    rows = [(i, t) for i, t in zip(order, texts)] + [(None, base[0]), (None, "only here, with no id"), (order[3], base[3])]
    docs = spark.createDataFrame([(*x, "x", 1, 2) for x in rows], "doc_id bigint, text string, _rk string, fp bigint, _doc bigint")
    marks = [simhash.fingerprint(simhash.shingle_hashes(t or "", 3)) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(marks):
        for j in range(i):
            if (x ^ marks[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        least[find(i)] = min(key, least.get(find(i), key))
    out = simhash.without_near_duplicates(docs)
    assert out.columns == docs.columns
    got = sorted((x.doc_id is None, x.doc_id or 0) for x in out.collect())
    assert got == sorted(least.values()) and len(got) < len(rows) - 20
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0


# language model


def test_gradients():
    p = gru.fresh(5, 4, np.zeros(5))
    r = np.random.default_rng(1)
    p = {k: (v + r.normal(size=v.shape) * 0.3).astype(np.float64) for k, v in p.items()}
    targets, inputs, begins, mask, _ = next(gru.Lanes([r.integers(0, 5, n) for n in (30, 3, 7, 1)], 2).windows(0))
    h = r.normal(size=(2, 4))
    _, grads, _ = gru.gradients(p, targets, inputs, begins, mask, h)
    for k in p:
        for _ in range(5):
            at = tuple(r.integers(0, s) for s in p[k].shape)
            loss = []
            for e in (1e-6, -1e-6):
                q = {a: x.copy() for a, x in p.items()}
                q[k][at] += e
                loss.append(gru.gradients(q, targets, inputs, begins, mask, h)[0])
            assert (loss[0] - loss[1]) / 2e-6 == pytest.approx(grads[k][at], abs=1e-6)


def test_state_and_segment_sums():
    """The model's size is no means to a time; sums by segment equal the product with a one-hot matrix."""
    assert recurrent_lm.HIDDEN >= 24
    r = np.random.default_rng(3)
    values, rows = r.normal(size=(200, 7)), r.choice([0, 2, 3, 8], 200)
    assert np.allclose(gru._sums(values, rows, 10), np.eye(10)[rows].T @ values)
    p = gru.fresh(10, 4, np.zeros(10))
    states, targets = r.normal(size=(20, 10, 4)), r.integers(0, 10, (20, 10))
    assert np.allclose(gru.log_of(p, states, targets), gru.log_softmax(p, states)[np.arange(200), targets.ravel()])


def test_likelihood_carries_the_state_through_whole_sequences():
    r = np.random.default_rng(2)
    p = gru.fresh(6, 5, np.zeros(6))
    p["W"] = r.normal(size=p["W"].shape).astype(np.float32)
    sequences = [r.integers(0, 6, n) for n in (50, 1, 17, 16, 33)]
    want = []
    for s in sequences:
        h, total, last = np.zeros((1, 5), np.float32), 0.0, 0
        for c in s:
            states, _ = gru.forward(p, np.array([[last]]), np.array([[False]]), h)
            total += float(gru.log_softmax(p, states)[0, c])
            h, last = states[-1], c
        want.append(total / np.log(10))
    monkey = gru.log10_likelihood(p, sequences, 0)
    assert np.allclose(monkey, want, atol=1e-4)
    assert gru.log10_likelihood(p, [], 0).shape == (0,)


def base_scores(rows):
    token_lists = [("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""), d) for d, t in rows]
    token_lists = [(words_in(t) + [None], zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1) for t, d in token_lists]
    counts = Counter(w for ws, held in token_lists if not held for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(rows[i][0], held, len(ws), sum(counts[w] > 0 for w in ws), n, sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, (ws, held) in enumerate(token_lists)]


@pytest.mark.parametrize("limit", [1 << 17, 50])
def test_language_model_counts_and_held_out_gain(spark, monkeypatch, limit):
    monkeypatch.setattr(recurrent_lm, "TABLE", limit)
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    extra = [(5000, None), (5001, ""), (5002, "\xa0 NEW Ünknown\x0bwords"), (None, "the of"), (None, "the of")]
    more = spark.createDataFrame([(*x, None, "c") for x in extra], "doc_id bigint, text string, lang string, score string")
    got = recurrent_lm.score_documents(docs.select("doc_id", "text", "lang", F.lit("c").alias("score")).unionByName(more)).collect()
    want = sorted(base_scores(rows + extra), key=str)
    assert [tuple(x)[:5] for x in sorted(got, key=lambda x: str(tuple(x)[:5]))] == [w[:5] for w in sorted(want, key=lambda w: str(w[:5]))]
    by_id = {w[0]: w[5] for w in want}
    assert all(x.base_score == pytest.approx(by_id[x.doc_id], rel=1e-9) for x in got)
    held = [x for x in got if x.held_out]
    assert sum(x.score for x in held) > sum(x.base_score for x in held) * 0.9
    assert all(x.score < 0 for x in got)


def test_shards_hold_every_training_row(spark):
    rows = [(i, bytes([i % 7, 0])) for i in range(50)] + [(7, bytes([9, 9, 0]))] * 40 + [(None, b"\0")] * 11
    docs = spark.createDataFrame(rows, "doc_id bigint, classes binary")
    got = recurrent_lm.sharded(docs, 6).collect()
    assert Counter(x for r in got for x in [(r.doc_id, bytes(r.classes))] * r.times) == Counter(rows)
    assert all(0 <= r.shard < 6 and r.times > 0 for r in got)
    assert sorted(r.times for r in got if r.doc_id == 7 and len(r.classes) == 3) == [6, 6, 7, 7, 7, 7]  # copies in all shards
    assert recurrent_lm.shard_numbers(0) == (3, 3) and recurrent_lm.shard_numbers(recurrent_lm.SHARD_TOKENS * 24) == (24, 6)


def test_language_model_is_the_same_under_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "SHARD_TOKENS", 5000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(docs.limit(5))
    found = []
    for parts in (1, 13):
        rows = recurrent_lm.score_documents(docs.repartition(parts, F.rand(parts))).collect()
        found.append(sorted((x.doc_id, x.n_tokens, x.score) for x in rows))
    assert [x[:2] for x in found[0]] == [x[:2] for x in found[1]]
    assert [x[2] for x in found[0]] == pytest.approx([x[2] for x in found[1]], rel=1e-4)


def test_language_model_without_documents(spark):
    schema = "doc_id bigint, text string, lang string"
    assert recurrent_lm.score_documents(spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = recurrent_lm.score_documents(spark.createDataFrame([(held, "a b", "en")], schema)).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)


# pipeline


def test_pipeline_with_clashing_columns(spark):
    columns = ["_rk", "_doc", "fp", "kept", "distance", "_key", "line", "removed", "n_words"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in columns})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        assert docs.columns == before.columns and 0 < docs.count() <= before.count(), name
        assert docs.where(" or ".join(f"{c} <> concat('{c}', doc_id)" for c in columns)).count() == 0


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        assert docs.columns == columns and docs.count() <= before.count(), name
    texts = {x.doc_id: x.text for x in docs.collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    packed_right(rows, texts, Tokenizer.from_file(catalog._vocabulary("byte_bpe_50k.json")))
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_registered_queries():
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(catalog.ORACLE) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(catalog.ORACLE[name])
    columns = [c[0] for c in want.description]
    want = sorted(map(tuple, want.fetchall()), key=str)
    got = sorted(map(tuple, catalog.QUERIES[name](spark, SMALL).select(*columns).collect()), key=str)
    assert got == want
