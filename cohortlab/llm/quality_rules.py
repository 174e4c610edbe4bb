"""Quality rules: counts of a text, and its divergence from its language.

A text's histogram of character classes and its histogram of common words are
compared with those of the language's whole corpus by Jensen-Shannon distance
(base 2, so 0 to 1).  How far a text's common words may be from its language's
follows from the reference: half of the distance that a text without any of
them has, widened for the chance in a text of its length.  Texts below a
minimum length are not judged: their histograms say too little.  Everything is
column expressions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, prepare, saved, show, words

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated windows
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_SHARE = 0.5  # of the distance of a text without common words
MIN_WORDS_FOR_HISTOGRAM = 100
COMMON_WORDS = 20
MIN_REFERENCE_WORDS = 1_000  # words from which on a language has a reference of its own
# squared distance that n words drawn from the reference itself have on average, times n: a bin adds 1 / (8 ln 2); one and a half times that is allowed
WORD_CHANCE = 1.5 * COMMON_WORDS / (8 * math.log(2))
BROADCAST_REFERENCES = 20_000  # references, of about 1 KB each, that are broadcast at most
_FIRST_BIN = 33  # bins are written as the characters from "!" on
#: Character classes in the order in which they are taken out of a text.
CLASSES = {"lower": "\\p{Ll}+", "space": "[\\x20\\x09-\\x0D]+", "upper": "\\p{Lu}+", "digit": "\\p{Nd}+", "stop": "[.,;:'\"()-]+", "mark": "[!?]+", "symbol": "[#*$%&|<>]+"}


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def window_hashes(own_words: str) -> Column:
    """64-bit hashes of the 3-word windows, in order."""
    parts = ", ".join(f"slice({own_words}, {i}, size({own_words}) - 2)" for i in (1, 2, 3))
    return F.expr(f"if(size({own_words}) < 3, cast(array() as array<bigint>), transform(arrays_zip({parts}), z -> xxhash64(z['0'], z['1'], z['2'])))")


def with_repeated_words(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """``df`` with ``name``: words in 3-word windows found twice or more, each
    word once.

    Many texts have no window twice; that shows in the number of distinct
    hashes.  Else the windows are sorted with their positions, those with an
    equal neighbour are taken, and the positions they cover are counted."""
    placed = f"if(size(array_distinct({hashes})) < size({hashes}), sort_array(transform({hashes}, (h, i) -> struct(h as h, i as i))), null)"
    twice = "filter(arrays_zip(slice(_placed, 1, size(_placed) - 1), slice(_placed, 2, size(_placed) - 1)), z -> z['0'].h = z['1'].h)"
    starts = f"array_distinct(flatten(transform({twice}, z -> array(z['0'].i, z['1'].i))))"
    covered = f"array_distinct(flatten(transform({starts}, i -> array(i, i + 1, i + 2))))"
    return df.withColumn("_placed", F.expr(placed)).withColumn(name, F.expr(f"if(_placed is null, 0L, cast(size({covered}) as bigint))"))


def js_distance(p: list[Column], q: list[Column]) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms that sum to one."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    terms = [part(a, (a + b) / 2) + part(b, (a + b) / 2) for a, b in zip(p, q)]
    return F.sqrt(F.greatest(reduce(lambda a, b: a + b, terms) / 2, F.lit(0.0)))


def foreign_distance(rest: Column) -> Column:
    """Jensen-Shannon distance of a text without common words to a reference
    in which other words have the share ``rest``."""
    both = F.log2(2 / (1 + rest)) + F.when(rest > 0, rest * F.log2(2 * rest / (1 + rest))).otherwise(F.lit(0.0))
    return F.sqrt(F.greatest((1 - rest + both) / 2, F.lit(0.0)))


def with_class_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_c_<class>`` counts of characters and ``_c_other``.  Each
    class is taken out of what the classes before it have left, so the text
    itself is read once."""
    df = df.withColumn("_left0", F.coalesce(F.col(text), F.lit("")))
    for i, (name, pattern) in enumerate(CLASSES.items()):
        df = df.withColumn(f"_left{i + 1}", F.regexp_replace(f"_left{i}", pattern, ""))
        df = df.withColumn(f"_c_{name}", (F.length(f"_left{i}") - F.length(f"_left{i + 1}")).cast("double"))
    last = len(CLASSES)
    return df.withColumn("_c_other", F.length(f"_left{last}").cast("double")).drop(*[f"_left{i}" for i in range(last + 1)])


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, dict]:
    """References of all languages with ``MIN_REFERENCE_WORDS`` words (a row
    each: _lang, _classes, _bins, _common, _foreign), and that of all texts together:
    shares of the classes, the common words (most frequent first, ties by code
    point) and their shares.  Counts cover the whole corpus; only the common
    words of all texts reach the driver."""
    own = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    names = [*CLASSES, "other"]
    sums = saved(with_class_counts(own, "text").groupBy("lang").agg(*[F.sum(f"_c_{c}").alias(c) for c in names]))
    counted = saved(own.select("lang", F.explode(words(F.col("text"))).alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    named = counted.filter("lang is not null")
    sizes = named.groupBy("lang").agg(F.sum("n").alias("words")).filter(F.col("words") >= MIN_REFERENCE_WORDS)
    # Spark cuts to the first ranks in each task before it shuffles
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    top = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= COMMON_WORDS)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "w", "n"))).alias("top"), F.sum("n").alias("found"))
    total = reduce(lambda x, y: x + y, [F.col(c) for c in names])
    known = top.join(sizes, "lang").join(sums.filter("lang is not null"), "lang").select(
        F.col("lang").alias("_lang"),
        F.array(*[F.col(c) / total for c in names]).alias("_classes"),
        F.expr(f"map_from_entries(transform(top, x -> struct(x.w, char({_FIRST_BIN - 1} + x.rank))))").alias("_bins"),
        F.expr(f"concat(transform(top, x -> x.n / words), array_repeat(0D, {COMMON_WORDS} - size(top)), array((words - found) / words))").alias("_common"),
        foreign_distance((F.col("words") - F.col("found")) / F.col("words")).alias("_foreign"),
    )
    classes = sums.agg(*[F.sum(c).alias(c) for c in names]).first()
    chars = sum(x or 0.0 for x in classes)
    n = counted.agg(F.sum("n")).first()[0] or 0
    most = counted.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(COMMON_WORDS).collect()
    shares = [r["n"] / n for r in most] + [0.0] * (COMMON_WORDS - len(most))
    rest = (n - sum(r["n"] for r in most)) / n if n else 0.0
    overall = {"classes": [(x or 0.0) / chars if chars else 0.0 for x in classes], "words": {r["w"]: chr(_FIRST_BIN + i) for i, r in enumerate(most)}, "common": [*shares, rest], "rest": rest}
    return saved(known), overall


def judge(docs: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE, max_word_share: float = MAX_WORD_SHARE, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED, min_histogram: int = MIN_WORDS_FOR_HISTOGRAM, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, class_distance, word_distance and kept (input
    columns of these names are replaced).

    base_failed: fewer than ``min_words`` words, or more than ``max_repeated``
    percent of them in repeated 3-word windows.  kept: not base_failed and,
    for texts of at least ``min_histogram`` words, both distances to the
    reference of their language within their limits (below that length the
    distances are given but don't count).  The limit of the words is
    ``max_word_share`` of the distance of a text that has none of the common
    words, its square plus ``WORD_CHANCE`` / n_words.  A null language and one of fewer than
    ``MIN_REFERENCE_WORDS`` words are compared with the reference of all texts.  Null, empty and word-less texts fail the
    base rule and have distances of null.  Repeated rows are judged alike; an
    empty table gives no rows.
    """
    prepare(docs.sparkSession)
    known, overall = references(docs, text_col, lang_col)
    if known.count() <= BROADCAST_REFERENCES:
        known = F.broadcast(known)
    df, names = hide(docs)
    text_col, lang_col = names[text_col], names[lang_col]
    results = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
    df = df.withColumn("_key", F.col(lang_col).cast("string")).join(known, F.col("_key") == F.col("_lang"), "left")
    df = df.withColumn("_words", words(F.col(text_col)))
    df = df.withColumn("_hashes", window_hashes("_words"))
    whole = F.create_map(*[F.lit(x) for pair in overall["words"].items() for x in pair]) if overall["words"] else F.create_map().cast("map<string,string>")
    df = with_repeated_words(df, "_hashes", "n_repeat_words").withColumns({"_bins": F.coalesce("_bins", whole), "n_words": F.size("_words").cast("long"), "n_dup_lines": repeated_lines(F.col(text_col))})
    # one character per common word: its bin (array_join leaves the nulls of other words out)
    df = df.withColumn("_drawn", F.array_join(F.transform("_words", lambda w: F.try_element_at("_bins", w)), ""))
    df = with_class_counts(df, text_col)
    # the classes are disjoint, so two of the counts are among theirs
    length = F.coalesce(F.length(text_col), F.lit(0))
    df = df.withColumns({"word_chars": (length - F.col("_c_space")).cast("long"), "n_symbols": F.col("_c_symbol").cast("long")})
    n, chars = F.col("n_words").cast("double"), F.greatest(length, F.lit(1)).cast("double")
    bins = [F.length("_drawn") - F.length(F.replace("_drawn", F.lit(chr(_FIRST_BIN + i)), F.lit(""))) for i in range(COMMON_WORDS)]
    drawn = [*[b / n for b in bins], (F.col("n_words") - F.length("_drawn")) / n]
    classes = [F.col(f"_c_{c}") / chars for c in (*CLASSES, "other")]

    def reference(name: str, key: str, size: int) -> list[Column]:
        whole = F.array(*[F.lit(x) for x in overall[key]])
        return [F.get(F.coalesce(F.col(name), whole), F.lit(i)) for i in range(size)]

    has_words = F.col("n_words") > 0
    df = df.withColumns({
        "class_distance": F.when(has_words, js_distance(classes, reference("_classes", "classes", len(CLASSES) + 1))),
        "word_distance": F.when(has_words, js_distance(drawn, reference("_common", "common", COMMON_WORDS + 1))),
        "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words")),
    })
    foreign = F.coalesce("_foreign", foreign_distance(F.lit(float(overall["rest"]))))
    word_limit = F.sqrt(F.pow(max_word_share * foreign, F.lit(2)) + WORD_CHANCE / F.col("n_words"))
    near = (F.col("class_distance") <= max_class_distance) & (F.col("word_distance") <= word_limit)
    df = df.withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") < min_histogram) | near))
    return show(df, names, *results)
