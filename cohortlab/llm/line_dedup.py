"""Line dedup: removes lines that are equal or near-equal to an earlier line.

An exact set-similarity join over lines as sets of words.  The words of a line
are ordered by rarity in the corpus; two lines of Jaccard similarity at least
``t`` must share one of their first ``n - ceil(t * n) + 1`` words (prefix
filter).  Lines that meet in a prefix word are dropped early by their lengths,
by the positions of the word (how much overlap is still possible), and by a
128-bit signature of the sets, in which every word flips one bit: as many bits
as differ, as many words at least are in one line only.  Two lines of n and m words that must share ``need``
words have one in their first ``n - need + 1`` and ``m - need + 1``, so a pair is
made there only.  The rest is verified on the words.

Equal lines are one row, with the position of the first.  Before the join every
line meets the earliest line that has two neighbouring words of its prefix in
common, of its less rare half, as the words that a near copy has for itself are
mostly rare ones: of a group of near copies nearly all lines are settled by
that, and need no partner more.  Lines that are still open are then joined with the
whole posting lists of their prefix words, so nothing is capped and no pair of
an open line is left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, matching, prepare, release, saved, show

SIMILARITY = 0.8
_BUCKETS = 1 << 18  # of word counts
_NEIGHBOURS = 5  # pairs of neighbouring words of a line that name its leaders
_EPS = 1e-9


def _parts(text: Column) -> Column:
    """Words of a text and an empty one between two white spaces."""
    text = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.split(text, " ")


def words(text: Column) -> Column:
    """Words as :func:`cohortlab.llm.common.words` gives them, without a
    regular expression."""
    return F.array_remove(_parts(text), "")


def _level(count):
    """Rarity level of a word count, 1 to 127: four steps for each doubling."""
    return np.minimum(127, 1 + np.round(4 * np.log2(np.asarray(count, float) + 1))).astype(np.uint8)


def rarity_levels(docs: DataFrame) -> Column:
    """Table of the levels of 2^18 hash buckets of words, from the counts of all
    words of the corpus, as a constant array.  A bucket is the first 18 bits of
    a hash, and its entry what turns the first byte of such a hash into the
    level.  The table has a fixed size; buckets that share words only make a
    word seem less rare, which changes costs, not results."""
    found = docs.select(F.explode(words(F.col("text"))).alias("w")).groupBy(_bucket(F.xxhash64("w")).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    levels = np.full(_BUCKETS, _level(0), np.uint8)
    levels[found["b"].to_numpy()] = _level(found["n"].to_numpy())
    entries = (levels ^ (np.arange(_BUCKETS) >> 10).astype(np.uint8)).astype(np.int8)
    # parts of one string, which Spark makes an array once, when it plans the query
    return F.split(F.lit(",".join(map(str, entries.tolist()))), ",").cast("array<tinyint>")


def _shifted(number: Column, by: Column) -> Column:
    return F.call_function("shiftleft", number.cast("long"), by.cast("int"))


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 46)


def _code(h: Column, levels: Column) -> Column:
    """A word hash as a number that sorts by rarity: its first byte is the level."""
    return F.coalesce(h.bitwiseXOR(_shifted(levels[_bucket(h)], F.lit(56))), h)  # never null, so arrays of it sort fast


def _hashes(line: Column) -> Column:
    """Hashes of the distinct words of a line.  What stands between two spaces
    is the empty word, which goes by its hash."""
    found = F.transform(_parts(line), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(found), F.xxhash64(F.lit("")))


def _lines(docs: DataFrame, *more: str) -> DataFrame:
    """(id, place, line, h) of the lines that hold a word.  h is a 64-bit hash
    of the line; place is the line number below 32 bits of the hash, so (id,
    place) names a line even where rows share an id."""
    rows = docs.select("id", *more, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.filter(F.rlike("line", F.lit("[^\\x20\\x09-\\x0D]"))).withColumn("h", F.xxhash64("line"))
    place = F.shiftleft("h", 32).bitwiseOR(F.col("line_no").cast("long"))
    return rows.select("id", *more, place.alias("place"), "line", "h")


def line_no(place: Column) -> Column:
    return place.bitwiseAND(F.lit(0xFFFFFFFF))


def _earlier(a: str, b: str) -> Column:
    """Line a stands before line b: by id (null first), then line number."""
    x, y = F.col(f"{a}.id"), F.col(f"{b}.id")
    before = line_no(F.col(f"{a}.place")) < line_no(F.col(f"{b}.place"))
    return (x < y) | (x.isNull() & y.isNotNull()) | (x.eqNullSafe(y) & before)


def _signatures(codes: str) -> tuple[Column, Column]:
    """128 parities of the words of a set by seven bits of their hashes, where
    a word flips one bit of one half: both halves xor-ed, and the second."""
    flip = lambda one: F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: a.bitwiseXOR(_shifted(one(c), c.bitwiseAND(F.lit(63)))))
    return flip(lambda c: F.lit(1)), flip(lambda c: F.shiftright(c, 6).bitwiseAND(F.lit(1)))


def _alike(n: Column, m: Column, t: float) -> Column:
    """Length and signature filter for rows a and b of n and m words.  Words
    that are in one line only flip one bit each, so both halves together must
    not differ in more bits than there may be such words."""
    need = F.ceil((n + m) * (t / (1 + t)) - _EPS)
    both, more = (F.col(f"a.{x}").bitwiseXOR(F.col(f"b.{x}")) for x in ("bits", "more"))
    return (F.least(n, m) >= F.greatest(n, m) * t - _EPS) & (F.bit_count(both.bitwiseXOR(more)) + F.bit_count(more) <= n + m - 2 * need)


def _can_match(t: float) -> Column:
    """Length, positional and signature filter for prefix rows a and b, whose
    ``at`` is the number of words (upper half) and the word's position.  A
    settled line has its number negated, and as ``a`` is like none.  Sets that
    share ``need`` words share one of their first n - need + 1 and m - need + 1."""
    n, m = F.shiftright("a.at", 32), F.abs(F.shiftright("b.at", 32))
    i, j = (F.col(x).bitwiseAND(F.lit(0xFFFFFFFF)) for x in ("a.at", "b.at"))
    need = F.ceil((n + m) * (t / (1 + t)) - _EPS)
    position = F.least(n - i, m - j) + F.least(i, j) >= need - 1
    return _alike(n, m, t) & (i <= n - need + 1) & (j <= m - need + 1) & position


def _verified(pairs: DataFrame, docs: DataFrame, t: float) -> DataFrame:
    """(id, place) of the later lines of ``pairs`` (saved; id, place of the
    later, e_id, e_place of the earlier line) whose word sets reach the
    similarity.  Only lines that stand in a pair are fetched."""
    ends = pairs.select("id", "place").unionByName(pairs.select(F.col("e_id").alias("id"), F.col("e_place").alias("place")))
    ends = saved(ends.distinct())
    lines = saved(matching(_lines(docs).select("id", "place", "line"), ends, ["id", "place"]).dropDuplicates(["id", "place"]))
    p, x, y = pairs.alias("p"), lines.alias("x"), lines.alias("y")
    both = p.join(x, F.col("p.id").eqNullSafe(F.col("x.id")) & (F.col("p.place") == F.col("x.place")))
    both = both.join(y, F.col("p.e_id").eqNullSafe(F.col("y.id")) & (F.col("p.e_place") == F.col("y.place")))
    # as arguments of a higher-order function, the word sets and what they share are made once a pair
    sets = F.struct(*[F.array_distinct(words(F.col(f"{z}.line"))).alias(z) for z in ("x", "y")])
    sizes = F.transform(F.array(sets), lambda z: F.struct(F.size(F.array_intersect(z["x"], z["y"])).alias("k"), (F.size(z["x"]) + F.size(z["y"])).alias("n")))
    reached = F.exists(sizes, lambda z: z["k"] >= (z["n"] - z["k"]) * t - _EPS)
    found = saved(both.filter(reached).select("p.id", "p.place").distinct())
    release(pairs, ends, lines)
    return found


def _prefix_length(n: Column, t: float) -> Column:
    return n - F.ceil(n * t - _EPS) + 1


def _keys(prefix: Column) -> Column:
    """Keys of the leaders of a line: pairs of neighbours in the less rare half
    of its prefix, those of the least hashes, so that near copies choose alike.
    A prefix of two or three words also goes by its last word, and one of a
    single word by that and the signature."""
    size = F.size(prefix)
    skip = F.greatest(F.least(F.floor(size / 2), size - 2), F.lit(0)).cast("int")
    half = F.slice(prefix, skip + 1, size)
    pairs = F.zip_with(half, F.slice(half, F.lit(2), size), lambda x, y: F.when(y.isNotNull(), F.xxhash64(x, y)))
    pairs = F.slice(F.sort_array(F.array_compact(pairs)), 1, _NEIGHBOURS)
    last = F.xxhash64(F.get(prefix, size - 1))
    return F.when(size > 3, pairs).when(size > 1, F.array_append(pairs, last)).otherwise(F.array(F.xxhash64(F.get(prefix, F.lit(0)), "bits")))


def _led(sets: DataFrame, t: float) -> DataFrame:
    """Pairs of a line and the earliest line that shares one of its keys (id,
    place, e_id, e_place), if length and signature allow."""
    rows = sets.select("id", "place", "n", "bits", "more", F.explode(_keys(F.col("prefix"))).alias("key"))
    least = F.min(F.struct("id", line_no(F.col("place")).alias("line_no"), "place", "n", "bits", "more"))
    leaders = rows.groupBy("key").agg(F.count(F.lit(1)).alias("k"), least.alias("l")).filter("k > 1").select("key", "l.id", "l.place", "l.n", "l.bits", "l.more")
    a, b = rows.alias("a"), leaders.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & _alike(F.col("a.n"), F.col("b.n"), t) & _earlier("b", "a"))
    return met.select("a.id", "a.place", F.col("b.id").alias("e_id"), F.col("b.place").alias("e_place")).distinct()


def duplicate_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` (id, text) -> one row per distinct line with a word: h, check
    (a second hash), id and place of its first occurrence, and ``near``:
    whether an earlier, different line has at least ``similarity``."""
    t = similarity
    number = line_no(F.col("place"))
    levels = rarity_levels(docs)
    codes = F.sort_array(F.transform(_hashes(F.col("line")), lambda h: _code(h, levels)))
    sets = _lines(docs).withColumn("check", F.xxhash64(F.lit(1), "line")).withColumn("codes", codes).withColumn("n", F.size("codes"))
    own = [half.alias(name) for half, name in zip(_signatures("codes"), ("bits", "more"))]
    prefix = F.slice("codes", F.lit(1), _prefix_length(F.col("n"), t).cast("int"))
    # equal lines have equal sets, so only the place decides which struct is the least
    sets = sets.groupBy("h").agg(F.min(F.struct("id", number.alias("line_no"), "place", "check", "n", *own, prefix.alias("prefix"))).alias("f"))
    sets = saved(sets.select("h", "f.check", "f.id", "f.place", "f.n", "f.bits", "f.more", "f.prefix"))

    settled = _verified(saved(_led(sets, t)), docs, t)
    marks = settled.select(F.col("id").alias("s_id"), F.col("place").alias("s_place"))
    done = sets.join(marks, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("place") == F.col("s_place")), "left")
    rows = done.select("id", "place", F.when(F.col("s_place").isNull(), F.col("n")).otherwise(-F.col("n")).alias("n"), "bits", "more", F.posexplode("prefix").alias("pos", "c"))
    rows = rows.select("c", "id", "place", _shifted(F.col("n"), F.lit(32)).bitwiseOR((F.col("pos") + 1).cast("long")).alias("at"), "bits", "more")
    # both sides are the same frame, so it is shuffled once
    a, b = rows.alias("a"), rows.alias("b")
    met = a.join(b, (F.col("a.c") == F.col("b.c")) & _can_match(t) & _earlier("b", "a"))
    met = met.select("a.id", "a.place", F.col("b.id").alias("e_id"), F.col("b.place").alias("e_place")).distinct()
    found = _verified(saved(met), docs, t)
    near = settled.unionByName(found).select(F.col("id").alias("near_id"), F.col("place").alias("near_place"))
    same = F.col("id").eqNullSafe(F.col("near_id")) & (F.col("place") == F.col("near_place"))
    known = saved(sets.select("h", "check", "id", "place").join(near, same, "left").select("h", "check", "id", "place", F.col("near_place").isNotNull().alias("near")))
    release(sets, settled, found)
    return known


def remove_duplicate_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_removed and the text without lines that repeat.

    A ``\\n``-separated line goes if an earlier line, by (id, line number) over
    the whole corpus, has a word set of Jaccard similarity of at least
    ``similarity``; equal lines have 1.  Lines without a word stay.  Texts
    without such lines are as before, a text that loses all its lines becomes
    empty; a null text stays null (0 lines).  Rows that share an id share
    positions, so repeated rows keep or lose the same lines; a null id comes
    before all others.  Input columns n_lines and n_removed are replaced; no
    rows give no rows.
    """
    prepare(docs.sparkSession)
    docs, names = hide(docs)
    own = docs.select(F.col(names[id_col]).alias("id"), F.col(names[text_col]).alias("text"))
    known = duplicate_lines(own, similarity)
    mark = F.xxhash64("text").alias("mark")
    places = _lines(own.select("id", "text", mark), "mark").select("id", "mark", "place", "h", F.xxhash64(F.lit(1), "line").alias("check"))
    a, b = places.alias("a"), known.alias("b")
    gone = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.check") == F.col("b.check")) & (F.col("b.near") | _earlier("b", "a")))
    gone = saved(gone.groupBy("a.id", "a.mark").agg(F.collect_set(line_no(F.col("a.place")).cast("int")).alias("gone")))
    release(known)
    text = F.col(names[text_col])
    same = F.col(names[id_col]).eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark"))
    joined = docs.withColumn("own_mark", F.xxhash64(text)).join(gone, same, "left")
    joined = joined.withColumn("parts", F.split(text, "\n")).withColumn("n_lines", F.coalesce(F.size("parts"), F.lit(0)))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("gone"))
    rebuilt = F.array_join(F.transform(stay, lambda i: F.get("parts", i)), "\n")
    out = joined.withColumns({names[text_col]: F.when(F.col("gone").isNull(), text).otherwise(rebuilt), "n_removed": F.coalesce(F.size("gone"), F.lit(0))})
    return show(out, names, "n_lines", "n_removed")
