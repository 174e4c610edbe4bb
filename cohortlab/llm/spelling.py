"""Spelling variants by composition of finite-state machines.

The words of a vocabulary that differ by exactly one inserted, deleted or
replaced code point are the pairs accepted by ``A . E . A``: the minimised
acceptor of the vocabulary, a transducer that makes one edit, and the acceptor
again.  Until the edit both sides of the composition are in the same state, as
the acceptor is deterministic, so what can follow is a property of that state
alone: it is worked out once for each state of the minimised machine, whatever
number of prefixes leads there.

The vocabulary never meets in one place.  A partition has the words of one
initial state, those with the same first code points: it accepts all pairs
whose first difference comes later.  Pairs that differ earlier have their last
code points in common and are accepted by the same machines over the reversed
words.  An initial state with too many words is moved on by one symbol: the
pairs that differ at that very symbol are an equi-join on the words without
it, and its successors are partitions of their own.  So no partition is large,
whatever share of the words begins or ends alike, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import LOWER, UPPER, hide, prepare, saved

#: A word is a run of letters of these classes.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is at least so many times as frequent as its variant.
RATIO = 5
#: Words of one partition; larger ones are moved on by a symbol.
PART_WORDS = 4000


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z lower-cased, of at
    least ``min_length`` code points and ``min_count`` occurrences.

    With ``drop_every`` a seeded part of the occurrences loses a letter (to
    measure how variants are found): where it divides ``h``, the crc32 of
    ``<id>:<run>``, the code point at ``h`` modulo the run's length goes.  A
    null text has no words, a null id counts as empty.  Occurrences are
    counted where they are read before anything is shuffled.
    """
    docs, names = hide(docs)
    found = docs.select(F.coalesce(F.col(names[id_col]).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(names[text_col], F.lit(LETTERS), F.lit(0))).alias("run"))
    # lower() on ASCII is fast; other letters than A-Z must stay as they are
    ascii_only = F.octet_length("run") == F.length("run")
    word = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    if drop_every:
        found = found.select("id", word.alias("run")).withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(F.col("h") % drop_every == 0, shorter).otherwise(F.col("run"))
    words = found.select(word.alias("word")).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


class Acceptor:
    """The minimised deterministic acceptor of a sorted list of distinct
    words: states are numbers, ``final[q]`` and ``moves[q]`` (symbol -> state)
    describe them, ``start`` is the first."""

    def __init__(self, words: list[str]):
        known, path, last = {}, [[False, []]], ""
        self.final, self.moves = [], []

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                state = self._state(known, *path.pop())
                path[-1][1].append((last[len(path) - 1], state))

        for word in words:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            settle(same)
            path.extend([False, []] for _ in range(len(word) - same))
            path[-1][0], last = True, word
        settle(0)
        self.start = self._state(known, *path[0])

    def _state(self, known: dict, final: bool, moves: list) -> int:
        """The state with this behaviour; equal ones are one state."""
        key = (final, *moves)
        if key not in known:
            known[key] = len(self.final)
            self.final.append(final)
            self.moves.append(dict(moves))
        return known[key]

    def common(self, p: int, q: int) -> Iterator[str]:
        """Words that both states accept."""
        todo = [(p, q, "")]
        while todo:
            p, q, read = todo.pop()
            if self.final[p] and self.final[q]:
                yield read
            ahead = self.moves[q]
            todo.extend((to, ahead[c], read + c) for c, to in self.moves[p].items() if c in ahead)

    def edits(self, q: int) -> list[tuple[str, str]]:
        """Pairs of words accepted from state ``q`` of which one becomes the
        other by an edit at their first difference, which is their first
        symbol: the composition's paths that leave the diagonal here."""
        moves, out = sorted(self.moves[q].items()), []
        for i, (c, to) in enumerate(moves):
            for d, other in moves[i + 1 :]:
                out.extend((c + rest, d + rest) for rest in self.common(to, other))
            out.extend((c + rest, rest) for rest in self.common(to, q) if not rest.startswith(c))
        return out

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All pairs of accepted words with exactly one edit, each once."""
        memo, todo = {}, [(self.start, "")]
        while todo:
            q, prefix = todo.pop()
            if q not in memo:
                memo[q] = self.edits(q)
            for u, v in memo[q]:
                yield prefix + u, prefix + v
            todo.extend((to, prefix + c) for c, to in self.moves[q].items())


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"a": [], "na": [], "b": [], "nb": []}
        for listed in batch.column("words"):
            counts = {w["w"]: w["n"] for w in listed.as_py()}
            for a, b in Acceptor(sorted(counts)).pairs():
                for name, value in zip(out, (a, counts[a], b, counts[b])):
                    out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k in "ab" else pa.int64()) for k, v in out.items()], names=list(out))


_PAIR = "a string, na long, b string, nb long"


def _edits_at(words: DataFrame, at: int) -> DataFrame:
    """Pairs of ``words`` (w, n) that share their first ``at`` code points and
    differ by one edit in the next: words with the same rest, found by the
    word without that code point."""
    cut = words.filter(F.length("w") > at).withColumn("k", F.concat(F.substring("w", 1, at), F.substring("w", F.lit(at + 2), F.length("w"))))
    cut = cut.withColumn("c", F.substring("w", at + 1, 1))
    one = cut.select("k", "c", F.col("w").alias("a"), F.col("n").alias("na"))
    two = cut.select("k", F.col("c").alias("d"), F.col("w").alias("b"), F.col("n").alias("nb"))
    replaced = one.join(two, "k").filter("c < d").select("a", "na", "b", "nb")
    shorter = words.select(F.col("w").alias("k"), F.col("n").alias("nb"))
    deleted = one.join(shorter, "k").filter(F.col("c") != F.substring("k", at + 1, 1)).select("a", "na", F.col("k").alias("b"), "nb")
    return replaced.unionByName(deleted)


def _pairs_after(words: DataFrame, depth: int, part_words: int) -> DataFrame:
    """(a, na, b, nb): pairs of ``words`` (w, n: saved) with one edit whose
    first difference comes after their first ``depth`` code points."""
    found, left = [], words
    while True:
        keyed = left.withColumn("part", F.substring("w", 1, depth))
        hot = saved(keyed.groupBy("part").count().filter(F.col("count") > part_words).select("part"))
        small = keyed.join(hot, "part", "left_anti")
        parts = small.groupBy("part").agg(F.collect_list(F.struct("w", "n")).alias("words")).filter(F.size("words") > 1)
        found.append(saved(parts.select("words").mapInArrow(_compose, _PAIR)))
        if hot.isEmpty():
            break
        left = saved(keyed.join(hot, "part", "left_semi").select("w", "n"))
        found.append(saved(_edits_at(left, depth)))
        depth += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, part_words: int = PART_WORDS) -> DataFrame:
    """(a, na, b, nb): every pair of distinct words of ``words`` (word, n:
    saved; words of ``min_length`` code points or more, at least 2) that
    differ by exactly one inserted, deleted or replaced code point, once, in
    either order, with both counts."""
    depth = min_length // 2
    words = words.select(F.col("word").alias("w"), "n")
    late = _pairs_after(words, depth, part_words)
    turned = saved(words.select(F.reverse("w").alias("w"), "n"))
    early = _pairs_after(turned, depth, part_words).select(F.reverse("a").alias("a"), "na", F.reverse("b").alias("b"), "nb")
    return late.unionByName(early.filter(F.substring("a", 1, depth) != F.substring("b", 1, depth)))


def spelling_variants(words: DataFrame, ratio: float = RATIO, min_length: int = MIN_LENGTH, part_words: int = PART_WORDS) -> DataFrame:
    """One row per word of ``words`` (word, n; as from :func:`word_counts`):
    ``word``, ``n``, ``n_near`` (near words), ``form`` (its most frequent near
    word, the smallest in code-point order of several, if at least ``ratio``
    times as frequent, else null), ``form_n`` and ``root`` (the last form that
    is reached from form to form; the word itself if it has none).

    Counts rise along a chain of forms, so it ends, after about log(count)
    forms; each round of following doubles the part that is done.  No words,
    no rows.
    """
    prepare(words.sparkSession)
    words = saved(words.select("word", "n"))
    pairs = saved(near_pairs(words, min_length, part_words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    is_form = -F.col("best.m") >= F.col("n") * ratio
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n"))
    known = saved(known)
    step = saved(known.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = step.join(ahead, "root", "left")
        if further.filter("next IS NOT NULL").isEmpty():
            break
        step = saved(further.select("word", F.coalesce("next", "root").alias("root")))
    return known.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))
