"""Deduplication of lines across documents, exact and within a small edit distance.

Lines of at least ``MIN_CHARS`` code points (trimmed of spaces) take part. Equal lines meet by two
64-bit hashes, combined before the shuffle. Each distinct line is then cut by a base, the least length of those
that are cut alike (a line near the next shorter one also by that): into the first third, a middle one and the
last. Two lines within ``EDITS`` edits share the first or the last, or have one edit in each and share the middle
one, moved by a place at most. Keys (base, segment number, hash of the segment) are made for the line's segments
and for the middle one a place further on. Lines that share a key are a group. Within a group, a count of letter classes bounds the distance
of two lines from below, and a banded bit-parallel automaton verifies it, unless links found
before join them already: a group gives fewer links than it has lines, and components are the same.

A key that more than ``CROWDED`` lines share is no group. Its lines meet by their lengths too; if that is
crowded, they are cut again, into
up to ``FINE`` segments: two near lines agree in all but two of these, the middle ones moved by a place
at most. Keys are made of all but two segments, so what is left is two short
windows. A key that is still crowded has its windows cut again under it, until about ``SHORT`` code
points are left. Then lines meet by their variants with up to ``EDITS`` of these deleted or blanked: an
equal variant proves the link, so a star links the lines of one. (``candidates`` gives the pairs instead, of
keys and variants that at most ``CROWDED`` or ``STARRED`` lines share.)

Of each component of lines (equal, or linked by verified pairs) the first line stays: the smallest
doc_id, then the place in the document. The others are removed from their documents.

The texts move once, into a table bucketed by row in the shared folder; all that follows moves
hashes and row numbers, and texts only of candidates.

Defined cases: null text stays null; shorter lines always stay; documents without such lines stay as
they are; a document whose lines all go keeps an empty text; repeated rows are documents of their
own; null doc_ids come first; empty table: no rows.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.llm.graph import components
from retention.session import materialize, scratch_path

MIN_CHARS, EDITS = 32, 2
CROWDED, SHORT, STARRED = 32, 12, 64
#: Most and fewest segments of a text whose keys are crowded, and code points of one in between.
FINE, COARSE, SEGMENT = 12, 5, 16
#: Texts of lengths up to 8 apart are cut alike, shorter ones than so many code points up to 4 apart.
NARROW = 64
#: One of so many lines is looked at for frequent keys; a key of more than CROWDED of these is one.
SAMPLED = 64
#: Letter classes whose counts bound the edit distance from below.
CLASSES = ["aäàáâãå", "eéèêë", "iíìîïjy", "oöóòôuüúùû", "nñmlr", "stzßcç", "dbpgkq", "hwfvx"]


def _line(raw: Column) -> Column:
    return F.trim(raw)


def store_rows(docs: DataFrame, what: str) -> DataFrame:
    """(_rk, _doc): the documents with a row number, in a table bucketed by it in the shared folder."""
    spark = docs.sparkSession
    name = f"{what}_{uuid.uuid4().hex[:12]}"
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_rk"))
    rows.repartition(n, "_rk").write.bucketBy(n, "_rk").option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written compressed to the shared folder and read again: keys compress little, all else well."""
    path = scratch_path(df.sparkSession, "keys")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lines(stored: DataFrame) -> DataFrame:
    """(_rk, doc_id, pos, x): the lines that take part."""
    cut = stored.where(F.col("_doc.text").isNotNull()).select("_rk", F.col("_doc.doc_id").alias("doc_id"), F.posexplode(F.split("_doc.text", "\n")).alias("pos", "raw"))
    return cut.select("_rk", "doc_id", "pos", _line(F.col("raw")).alias("x")).where(F.length("x") >= MIN_CHARS)


def _base(n: str) -> str:
    """SQL for the fewest code points of a text that is cut like one of ``n``: lines of about one length are cut alike."""
    return f"cast({n} - {n} % if({n} < {NARROW}, 4, 8) as int)"


def _measured(texts: DataFrame) -> DataFrame:
    """``texts`` with u, x as four bytes a code point (cut without counting characters), its number n of code points,
    and the bases it is cut by: ``home``, and ``below``, that of a line shorter by EDITS, where that is another."""
    texts = texts.withColumn("u", F.encode("x", "UTF-32")).withColumn("n", F.expr("cast(length(u) div 4 as int)"))
    return texts.withColumns({"home": F.expr(_base("n")), "below": F.expr(_base(f"(n - {EDITS})"))})


def _slice(start: str, size: str) -> str:
    """SQL for ``size`` code points of u from ``start`` (from 1)."""
    return f"substring(u, cast(4 * ({start}) - 3 as int), cast(4 * ({size}) as int))"


def _keys(base: str, own: str) -> list[str]:
    """SQL for (key, own) of the segments by a base: the first third, the last and the middle one. Of two near lines
    with edits in the first and in the last third, these are one each, so the middle is moved by one place at most; to
    the right, if the line is the longer one. Of two lines of equal length, either finds the other."""
    part, rest = f"({base} div 3)", f"({base} - 2 * ({base} div 3))"
    cuts = [(0, "1", part, own), (1, f"{part} + 1", part, own), (1, f"{part} + 2", part, "false"), (2, f"n - {rest} + 1", rest, own)]
    return [f"named_struct('key', xxhash64({base}, {i}, {_slice(start, size)}), 'own', {flag})" for i, start, size, flag in cuts]


def _posts() -> str:
    """SQL for an array of (key, own). Of two near lines, one has the key as its own."""
    home = _keys("home", "true")
    return f"if(below = home, array({', '.join(home)}), array({', '.join(home + _keys('below', 'false'))}))"


def _left_out(parts: int) -> list[tuple[int, int, int]]:
    """(first, second, shift): two of so many segments that are left out, and how far the segments between them are moved. Edits
    in both are one each, so that is one place at most (as in ``_keys``); two edits in one leave out a neighbour too."""
    return [(i, j, s) for i in range(parts) for j in range(i + 1, parts) for s in ((0, 1) if j > i + 1 else (0,))]


def _fine(left: DataFrame) -> DataFrame:
    """(id, key, own, ops): the keys of texts x under ``above``; ops, with the places of the two windows that a key
    leaves out, says how to come from the line to them. Code points beyond the base are in the second window."""
    cuts = F.array(*(F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("i", "j", "shift"), cut))) for cut in _left_out(p))) for p in range(COARSE, FINE + 1)))
    each = _measured(left).select("id", "above", "ops", "u", "n", "home", F.explode(F.array_distinct(F.array("home", "below"))).alias("len"))
    # the number of segments follows from the base, which both lines know
    each = each.withColumn("p", F.least(F.lit(FINE), F.greatest(F.lit(COARSE), F.expr(f"cast(len div {SEGMENT} as int)"))))
    each = each.withColumn("_c", F.explode(F.get(cuts, F.col("p") - COARSE))).select("id", "above", "ops", "u", "n", "home", "len", "p", "_c.*")

    def begin(segment: str) -> Column:
        return F.expr(f"cast(1 + (len div p) * {segment} + greatest(0, len % p - (p - {segment})) as int)")

    each = each.withColumns({"_si": begin("i"), "_ei": begin("(i + 1)"), "_sj": begin("j"), "_ej": begin("(j + 1)")})
    key = F.expr(f"xxhash64(above, len, i, j, {_slice('1', '_si - 1')}, {_slice('_ei + shift', '_sj - _ei')}, {_slice('n - len + _ej', 'len + 1 - _ej')})")
    op = F.array(F.expr("_si"), F.expr("_ei + shift - _si"), F.expr("_sj + shift"), F.expr("n - len + _ej - _sj - shift"))
    return each.select("id", key.alias("key"), ((F.col("len") == F.col("home")) & (F.col("shift") == 0)).alias("own"), F.concat("ops", op).alias("ops"))


NO_OPS = "cast(array() as array<int>)"


def _applied(ops: Column, start: Column, part) -> Column:
    """``start`` after each of ``ops`` (start and size of two windows, four numbers each), parts by ``part``."""
    steps = F.filter(F.transform(ops, lambda o, k: F.when(k % 4 == 0, F.slice(ops, k + 1, F.lit(4)))), lambda o: o.isNotNull())
    return F.aggregate(steps, start, lambda t, o: F.concat(part(t, o[0], o[1]), part(t, o[2], o[3])))


def _windows(x: Column, ops: Column) -> Column:
    """The text that is left of a line after each of ``ops``."""
    return _applied(ops, x, F.substring)


def _places(x: Column, ops: Column) -> Column:
    """The places of that text in the line."""
    return _applied(ops, F.sequence(F.lit(1), F.length(x)), F.slice)


def _met(keyed: DataFrame) -> DataFrame:
    """(key, own, id, n, ...): the rows whose key belongs to two lines or more, one of them with a segment of
    its own; n counts its rows. Counts are combined before the shuffle; Spark splits a frequent key's join."""
    of_key = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("_a"), F.max("id").alias("_b"), F.max("own").alias("_own"))
    return keyed.join(of_key.where("_a != _b and _own").select("key", "n"), "key")


def _shared(keyed: DataFrame, frequent: DataFrame) -> DataFrame:
    """(key, id, size, own, often, n): the rows whose key belongs to two lines or more, one of them with a segment of
    its own; n counts its rows. The rows of ``frequent`` keys (``often``), crowded anyway, are spread instead of counted (key
    is then a hash of key and id): no key goes to one task. ``how`` is 1 for own segments, 2 for these."""
    from pyspark.sql import Window

    rows = keyed.join(F.broadcast(frequent.withColumn("_often", F.lit(True))), "key", "left")
    how = F.when(F.col("_often"), 2).when(F.col("own"), 1).otherwise(0).cast("tinyint")
    rows = rows.select(F.when(F.col("_often"), F.xxhash64("key", "id")).otherwise(F.col("key")).alias("key"), "id", "size", how.alias("how"))
    of_key = Window.partitionBy("key")
    seen = rows.withColumns({"n": F.count("*").over(of_key), "_a": F.min("id").over(of_key), "_b": F.max("id").over(of_key), "_own": F.max("how").over(of_key)})
    seen = seen.where("how = 2 or _a != _b and _own > 0")
    return seen.select("key", "id", "size", (F.col("how") == 1).alias("own"), (F.col("how") == 2).alias("often"), F.when(F.col("how") < 2, F.col("n")).otherwise(CROWDED + 1).alias("n"))


def _of_length(crowded: DataFrame) -> DataFrame:
    """(id, key, own): keys of a base, met by lengths: a line of ``size`` code points meets those up to EDITS shorter."""
    each = crowded.withColumn("less", F.explode(F.array(*(F.lit(d) for d in range(EDITS + 1)))))
    return each.select("id", F.expr("xxhash64(key, size - less)").alias("key"), F.expr("own and less = 0").alias("own"))


def class_counts(x: Column) -> Column:
    """Counts of the letter classes; a substitution changes two by one, other edits one."""
    return F.struct(*((F.length(x) - F.length(F.translate(x, c, ""))).alias(f"c{i}") for i, c in enumerate(CLASSES)))


def _apart(a: Column, b: Column) -> Column:
    return sum((F.abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(1, len(CLASSES))), F.abs(a["c0"] - b["c0"]))


def _sampled(name: str) -> Column:
    return F.pmod(F.col(name), F.lit(SAMPLED)) == 0


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs of ids that share a key which is a segment of its own line for one of them."""
    left = rows.where("own").select("key", F.col("id").alias("a"))
    right = rows.select("key", F.col("id").alias("b"), F.col("own").alias("_both"))
    on = (left["key"] == right["key"]) & (F.col("a") != F.col("b")) & (~F.col("_both") | (F.col("a") < F.col("b")))
    return left.join(right, on).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _by_variants(left: DataFrame, fetch) -> DataFrame:
    """(key, own, id, n): the lines that share a variant with another, n in all, of lines that differ only in
    places (id, at) that are left. Lines of equal length share one with two places blanked, or with one deleted each; of
    others, the longer has one more deleted than the shorter. A variant of the first kinds proves a link
    between any two that share it, one of the others between a shorter line and any."""
    one = "transform(at, i -> named_struct('i', i, 'j', 0))"
    two = "flatten(transform(at, i -> transform(filter(at, j -> j > i), j -> named_struct('i', i, 'j', j))))"
    places = left.select("id", F.explode(F.expr(f"concat({one}, {two}, array(named_struct('i', 0, 'j', 0)))")).alias("_p")).select("id", "_p.i", "_p.j").distinct()
    blank, gone = "'\\n'", "''"  # a line has no line break

    def variant(tag: str, at_i: str, at_j: str | None, short: str) -> str:
        tail = "substring(x, i + 1)" if at_j is None else f"substring(x, i + 1, j - i - 1), {at_j}, substring(x, j + 1)"
        return f"named_struct('key', xxhash64('{tag}', concat(substring(x, 1, i - 1), {at_i}, {tail})), 'own', {short})"

    singles = [variant("deleted", gone, None, "true"), variant("longer", gone, None, "false"), variant("mixed", blank, None, "true")]
    doubles = [variant("blanked", blank, blank, "true"), variant("longer", gone, gone, "false"), variant("mixed", blank, gone, "false"), variant("mixed", gone, blank, "false")]
    whole = "named_struct('key', xxhash64('longer', x), 'own', true)"
    made = F.expr(f"case when i = 0 then array({whole}) when j = 0 then array({', '.join(singles)}) else array({', '.join(doubles)}) end")
    lines = fetch(left.select("id").distinct())
    keyed = _kept(places.join(lines.select("id", "x"), "id").select("id", F.explode(made).alias("_v")).select("id", "_v.key", "_v.own").distinct())
    return _kept(_met(keyed))


def _stars(met: DataFrame) -> DataFrame:
    """(a, b): the lines of each variant, linked to the first that has it as its own, which proves a link to any."""
    least = met.where("own").groupBy("key").agg(F.min("id").alias("_c"))
    return met.join(least, "key").where("id != _c").select(F.least("id", "_c").alias("a"), F.greatest("id", "_c").alias("b"))


def _levels(lines: DataFrame, fetch, sample: DataFrame | None):
    """The rows (key, own, id) of keys that at most CROWDED lines share, of each level of cutting, and those of
    variants (with n, the lines that share one): pairs of a name and a frame."""
    keys = lambda of: _measured(of).select("id", F.col("n").alias("size"), F.explode(F.expr(_posts())).alias("_k")).select("id", "size", "_k.key", "_k.own")
    some = lines.where(_sampled("id")) if sample is None else sample
    frequent = materialize(keys(some).groupBy("key").agg(F.count("*").alias("_c")).where(f"_c > {CROWDED}").select("key"))
    # the widest shuffle of the operator: a key, an id, a length and a flag a row
    shared = _kept(_shared(keys(lines), frequent))
    yield "keys", shared.where(f"n <= {CROWDED}").select("key", "own", "id")
    met = _kept(_met(_of_length(shared.where(f"n > {CROWDED} and not often"))))
    yield "keys", met.where(f"n <= {CROWDED}").select("key", "own", "id")
    # two near lines share a key that isn't crowded, or both have a crowded one
    crowded = shared.where("often").select("id").unionByName(met.where(f"n > {CROWDED}").select("id")).distinct()
    texts = _kept(fetch(crowded).select("id", "x"))
    parts = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = texts.select("id", F.lit(0).cast("bigint").alias("above"), F.expr(NO_OPS).alias("ops"))
    while not rows.isEmpty():
        left = rows.join(texts, "id").select("id", "above", "ops", F.col("x").alias("_line"), _windows(F.col("x"), F.col("ops")).alias("x"))
        # a line has few texts or many: they are dealt one by one, as a text gives many keys
        left = left.withColumn("n", F.length("x")).repartition(parts, "id", "above", "ops")
        # two near texts both end here, or both are cut again: one of about SHORT code points does both
        ended = _kept(left.where(f"n <= {SHORT + EDITS}").select("id", _places(F.col("_line"), F.col("ops")).alias("at")).distinct())
        if not ended.isEmpty():
            yield "variants", _by_variants(ended, fetch)
        met = _kept(_met(_kept(_fine(left.where(f"n > {SHORT}")))))
        yield "keys", met.where(f"n <= {CROWDED}").select("key", "own", "id")
        rows = met.where(f"n > {CROWDED}").select("id", F.col("key").alias("above"), "ops").distinct()


def candidates(lines: DataFrame, fetch=None, sample: DataFrame | None = None) -> DataFrame:
    """(a, b): ids of lines (id, x) that may be within EDITS edits: all pairs that are, but for those of
    crowded variants, where a star stands for them. ``fetch`` gives the lines of a frame of ids without
    moving the others, ``sample`` one of SAMPLED of all."""
    fetch = fetch or (lambda ids: lines.join(ids, "id", "left_semi"))
    found = []
    for name, rows in _levels(lines, fetch, sample):
        few = rows if name == "keys" else rows.where(f"n <= {STARRED}")
        found += [_pairs(few)] + ([_stars(rows.where(f"n > {STARRED}"))] if name == "variants" else [])
    return reduce(DataFrame.unionByName, found).distinct()


def groups(lines: DataFrame, fetch, sample: DataFrame | None = None) -> DataFrame:
    """(key, id): lines that share a key, at most CROWDED; any two near lines are in one group or joined by
    several. Grows with the keys of the lines, not with their pairs."""
    found = []
    for name, rows in _levels(lines, fetch, sample):
        if name == "variants":
            rows = _stars(rows).distinct().select(F.xxhash64("a", "b").alias("key"), F.explode(F.array("a", "b")).alias("id"))
        found.append(rows.select("key", "id"))
    return _kept(reduce(DataFrame.unionByName, found))


def _forest(members: Column) -> Column:
    """Links (a, b) between members (id, counts, x) within EDITS edits: those that join lines not joined yet."""
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    start = F.struct(F.sequence(F.lit(0), F.size(members) - 1).alias("root"), none.alias("links"))
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(members) - 1), lambda j: F.transform(F.sequence(F.lit(0), j - 1), lambda i: F.struct(i.alias("i"), j.alias("j")))))

    def step(s: Column, p: Column) -> Column:
        u, v, at, to = F.get(members, p["i"]), F.get(members, p["j"]), F.get(s["root"], p["i"]), F.get(s["root"], p["j"])
        link = F.array(F.struct(u["id"].alias("a"), v["id"].alias("b")))
        joined = F.struct(F.transform(s["root"], lambda r: F.when(r == to, at).otherwise(r)).alias("root"), F.concat(s["links"], link).alias("links"))
        return F.when((at != to) & (_apart(u["counts"], v["counts"]) <= 2 * EDITS) & within(u["x"], v["x"]), joined).otherwise(s)

    return F.aggregate(pairs, start, step, lambda s: s["links"])


def linked(grouped: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): links between the lines of each group, verified; in all they join the same lines as every pair
    of near ones in a group would, and a group gives fewer than its lines. ``known``: (id, counts, x)."""
    parts = max(1, int(known.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # near lines share most of their keys: equal groups are one before any text moves
    ids = grouped.groupBy("key").agg(F.sort_array(F.collect_set("id")).alias("ids")).select("ids").distinct()
    rows = ids.select(F.xxhash64("ids").alias("key"), F.explode("ids").alias("id")).join(known.select("id", "counts", "x"), "id")
    # an automaton is work beyond its bytes: groups are dealt to as many tasks as the session shuffles to
    whole = rows.repartition(parts, "key").groupBy("key").agg(F.collect_list(F.struct("id", "counts", "x")).alias("m"))
    return whole.select(F.explode(_forest(F.col("m"))).alias("_l")).select("_l.a", "_l.b").distinct()


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two texts' edit distance is at most ``edits``: a bit-parallel automaton over the band of
    2 * edits + 1 diagonals. Bit k of set d says that the characters read so far match those of b up
    to k - edits places further on with at most d errors."""
    width = 2 * edits + 1

    def masks(left: Column, right: Column) -> Column:
        """For each character of left, the diagonals on which right has the same."""
        def mask(c: Column, i: Column) -> Column:
            out = F.when(c == F.get(right, i - edits), 1).otherwise(0)
            for k in range(1, width):
                out = out + F.when(c == F.get(right, i + (k - edits)), 1 << k).otherwise(0)
            return out

        return F.transform(left, mask)

    start = F.struct(*(F.lit(sum(1 << k for k in range(edits, edits + d + 1))).alias(f"r{d}") for d in range(edits + 1)))

    def step(s: Column, m: Column) -> Column:
        sets = [s["r0"].bitwiseAND(m)]
        for d in range(1, edits + 1):
            kept = s[f"r{d}"].bitwiseAND(m).bitwiseOR(s[f"r{d - 1}"]).bitwiseOR(F.shiftright(s[f"r{d - 1}"], 1)).bitwiseOR(F.shiftleft(sets[-1], 1))
            sets.append(kept.bitwiseAND(F.lit((1 << width) - 1)))
        return F.struct(*(x.alias(f"r{d}") for d, x in enumerate(sets)))

    # only what lies between the common beginning and the common end is compared; lambda variables hold what is used more than once
    def middle(t: Column, p: Column, q: Column) -> Column:
        return F.filter(F.split(F.substring(t, p + 1, F.greatest(F.length(t) - p - q, F.lit(0))), ""), lambda c: c != "")

    def reached(sides: Column) -> Column:
        left, right = sides["l"], sides["r"]
        end = F.size(right) - F.size(left) + edits
        bits = F.aggregate(masks(left, right), start, step, lambda s: s[f"r{edits}"])
        return F.call_function("shiftright", bits, F.greatest(end, F.lit(0))).bitwiseAND(F.lit(1)) == 1

    halves = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    room = F.least(F.length(a), F.length(b))
    begin = F.aggregate(halves, F.lit(0), lambda p, s: F.when((s <= room - p) & (F.substring(a, p + 1, s) == F.substring(b, p + 1, s)), p + s).otherwise(p))

    def ends(p: Column) -> Column:
        q = F.aggregate(halves, F.lit(0), lambda q, s: F.when((s <= room - p - q) & (F.substring(a, F.length(a) - q - s + 1, s) == F.substring(b, F.length(b) - q - s + 1, s)), q + s).otherwise(q))
        return F.struct(p.alias("p"), q.alias("q"))

    cut = F.transform(F.transform(F.array(begin), ends), lambda e: F.struct(middle(a, e["p"], e["q"]).alias("l"), middle(b, e["p"], e["q"]).alias("r")))
    return (F.abs(F.length(a) - F.length(b)) <= edits) & F.get(F.transform(cut, reached), 0)


def removals(stored: DataFrame) -> DataFrame:
    """(_rk, pos, near): the lines to remove from a stored table's documents; near: not an exact copy of
    the line that stays, but linked to it."""
    hashed = _lines(stored).select(F.xxhash64("x").alias("h"), F.xxhash64(F.lit(1), F.col("x")).alias("g"), F.struct("doc_id", "_rk", "pos").alias("at"))
    lines = materialize(hashed.groupBy("h", "g").agg(F.count("*").alias("n"), F.min("at").alias("first")))
    where = lines.select(F.col("first._rk").alias("_rk"), F.col("first.pos").alias("pos"), F.col("h").alias("id"), "first")

    def texts(of: DataFrame) -> DataFrame:
        """(id, first, x) of distinct lines, read at their first places; the stored side isn't shuffled."""
        marked = of.groupBy("_rk").agg(F.collect_list(F.struct("pos", "id", "first")).alias("_at"))
        cut = stored.select("_rk", F.split("_doc.text", "\n").alias("_l")).join(marked, "_rk")
        return cut.select(F.explode(F.transform("_at", lambda p: F.struct(p.id.alias("id"), p.first.alias("first"), _line(F.get("_l", p.pos)).alias("x")))).alias("_x")).select("_x.*")

    def fetch(ids: DataFrame) -> DataFrame:
        return texts(where.join(ids, "id").select("_rk", "pos", "id", "first"))

    grouped = groups(texts(where).select("id", "x"), lambda ids: fetch(ids).select("id", "x"), texts(where.where(_sampled("id"))).select("id", "x"))
    known = _kept(fetch(grouped.select("id").distinct()).withColumn("counts", class_counts(F.col("x"))))
    first = known.select("id", "first")
    near = linked(grouped, known).join(first.toDF("a", "u"), "a").join(first.toDF("b", "v"), "b")
    rooted = components(near.select("u", "v"), "u", "v").select(F.col("node").alias("first"))
    exact = hashed.join(lines.where("n > 1").select("h", "g", "first"), ["h", "g"]).where(F.col("at") != F.col("first"))
    # a line whose class is linked to an earlier one goes with all its copies; the copies go anyway
    gone = exact.select(F.col("at._rk").alias("_rk"), F.col("at.pos").alias("pos"), F.lit(False).alias("near"))
    return gone.unionByName(rooted.select(F.col("first._rk").alias("_rk"), F.col("first.pos").alias("pos"), F.lit(True).alias("near")))


def _without(text: Column, gone: Column) -> Column:
    kept = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.when(~F.array_contains(gone, i), x)), lambda x: x.isNotNull())
    return F.array_join(kept, "\n")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with an array ``_removed`` of (pos, near) (null: none); ``_doc`` is the row."""
    stored = store_rows(docs, "lines")
    gone = removals(stored).groupBy("_rk").agg(F.sort_array(F.collect_list(F.struct("pos", "near"))).alias("_removed"))
    return stored.join(gone, "_rk", "left")


def _kept_text() -> Column:
    places = F.transform("_removed", lambda r: r.pos)
    return F.when(F.col("_removed").isNull(), F.col("_doc.text")).otherwise(_without(F.col("_doc.text"), places))


def remove_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines: columns as they came, text (and n_chars, if it is there) anew."""
    columns = []
    for field in docs.schema.fields:
        c = F.col("_doc").getField(field.name)
        if field.name == "text":
            c = _kept_text()
        elif field.name == "n_chars":
            c = F.when(F.col("_removed").isNull(), c).otherwise(F.length(_kept_text()).cast(T.LongType()))
        columns.append(c.alias(field.name))
    return deduplicated(docs).select(*columns)


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_exact, n_near, removed, kept_sha256): a row per document; removed: the places
    of its removed lines, from 0; kept_sha256: lowercase hex digest of the text that is left."""
    found = deduplicated(docs.select("doc_id", "text"))
    near = lambda flag: F.coalesce(F.size(F.filter("_removed", lambda r: r.near == flag)), F.lit(0)).cast("bigint")
    none = F.array().cast("array<int>")
    return found.select(
        F.col("_doc.doc_id").alias("doc_id"), F.size(F.split(F.coalesce("_doc.text", F.lit("")), "\n")).cast("bigint").alias("n_lines"),
        F.when(F.col("_removed").isNull(), 0).otherwise(near(False)).alias("n_exact"), F.when(F.col("_removed").isNull(), 0).otherwise(near(True)).alias("n_near"),
        F.coalesce(F.transform("_removed", lambda r: r.pos), none).alias("removed"), F.sha2(F.coalesce(_kept_text(), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
