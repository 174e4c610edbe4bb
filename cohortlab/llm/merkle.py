"""Merkle manifest of a dataset by bitmap ranks.

Every row is a leaf; the leaves of a group stand in ascending order of their
id, and every two neighbours become one node until one is left.  Where a leaf
stands is found without sorting leaves:

* the ids of a group are a bitmap of 64-bit words, of which only those that
  hold an id are stored.  Map tasks build and Spark merges them (``bit_or``);
* a popcount directory says how many leaves lie below a run of 1,024 words,
  the next one how many below 1,024 such runs, and so on; running sums within
  a run give each word the number of leaves before it;
* the rank of an id is that number plus the set bits below its own.

Rank ``r`` is slot ``r mod 256`` of the slot array ``r div 256``.  The arrays
are keyed groups of bounded size, so a group with most of the rows is as many
independent arrays as it needs.  A round reduces each array by up to eight
levels and its nodes are the slots of the next; on the way down again every
array adds its siblings to the path that it was handed from above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import prepare, saved
from cohortlab.plans.scale import global_ranks

#: Fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one slot array reduces; it has 2 ** LEVELS slots.
LEVELS = 8
#: Bits of a word number that one level of the directory covers.
RUN_BITS = 10
#: Added to word numbers, so that they are not negative and 0 is the word of null ids.
_WORD_SHIFT = 1 << 58


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    """sha256 (hex) of the framed values, one after the other."""
    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def _leaves(docs: DataFrame, id_col: str, group_col: str, fields, observed: Mapping[str, Column]) -> DataFrame:
    """(g, id, leaf, seen): group key in the order of the groups (null first,
    then bytewise), id, digest, and the digest of the observed row where it
    differs from the row (else null)."""
    real, other = [F.col(f) for f in fields], [observed.get(f, F.col(f)) for f in fields]
    changed = F.lit(False)
    for f in observed:
        if f in fields:
            changed = changed | ~F.col(f).eqNullSafe(observed[f])
    group = F.col(group_col).cast("string")
    return docs.select(
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("g"),
        F.col(id_col).cast("long").alias("id"),
        F.unhex(leaf_digest(real)).alias("leaf"),
        F.when(changed, F.unhex(leaf_digest(other))).alias("seen"),
    )


def bitmap_words(rows: DataFrame) -> DataFrame:
    """(g, word, bits, n): the non-empty words of each group's bitmap of ids
    and the rows of each.  Null ids are the word before all others."""
    keyed = rows.select("g", _word().alias("word"), F.expr("shiftleft(1L, int(coalesce(id, 0) & 63))").alias("bit"))
    return keyed.groupBy("g", "word").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))


def _word() -> Column:
    return F.coalesce(F.shiftright("id", 6) + F.lit(_WORD_SHIFT), F.lit(0).cast("long"))


def with_directory(words: DataFrame) -> DataFrame:
    """``words`` with ``base`` (rows of the group in all words before) and
    ``total`` (rows of the group).  Every level of the directory adds up runs
    of 1,024 entries of the level below, up to one run for all, which takes
    six levels at most; each window is one run."""
    levels = [words.withColumnRenamed("word", "key")]
    while True:
        low, high = levels[-1].agg(F.min("key"), F.max("key")).first()
        if low == high:
            break
        up = levels[-1].groupBy("g", F.shiftright("key", RUN_BITS).alias("key")).agg(F.sum("n").alias("n"))
        levels.append(saved(up))
    above = levels.pop().withColumn("base", F.lit(0).cast("long")).withColumn("total", F.col("n"))
    while levels:
        run = Window.partitionBy("g", "run").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        below = levels.pop().withColumn("run", F.shiftright("key", RUN_BITS))
        below = below.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
        parents = above.select("g", F.col("key").alias("run"), F.col("base").alias("start"), "total")
        above = below.join(parents, ["g", "run"]).withColumn("base", F.col("start") + F.col("before")).drop("run", "start", "before")
    return above.withColumnRenamed("key", "word")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (g, id, leaf, seen: saved) with ``pos``, the place of the row
    among its group's by (id, leaf), nulls first, from 0, and ``total``.

    The bitmap alone ranks distinct ids.  Where a word has more rows than set
    bits, ids repeat: these are counted, added to the ranks of the ids above
    them in their word, and only their rows are ordered among themselves by
    leaf (range-partitioned, so an id with a third of all rows is split).
    Rows with equal leaves take their places in any order.
    """
    words = saved(bitmap_words(rows))
    bit = F.expr("int(coalesce(id, 0) & 63)")
    rows = rows.withColumn("word", _word()).withColumn("bit", bit)
    directory = saved(with_directory(words))
    repeating = directory.filter("n > bit_count(bits)").select("g", "word")
    if repeating.isEmpty():
        plain = rows.join(directory.drop("n"), ["g", "word"])
        return plain.withColumn("pos", F.expr("base + bit_count(bits & ~shiftleft(-1L, bit))")).drop("word", "bit", "bits", "base")
    counts = rows.select("g", "word", "bit").join(repeating, ["g", "word"]).groupBy("g", "word", "bit").agg((F.count(F.lit(1)) - 1).alias("more"))
    counts = saved(counts.filter("more > 0"))
    extra = counts.groupBy("g", "word").agg(F.collect_list(F.struct("bit", "more")).alias("extra"))
    directory = directory.drop("n").join(extra, ["g", "word"], "left")
    keys = [*rows.columns]
    again = rows.join(counts.select("g", "word", "bit"), ["g", "word", "bit"], "left_semi").select(*keys)
    again = global_ranks(again, ["leaf", "seen"], ["g", "word", "bit"]).withColumn("among", F.col("_rank") - 1).select(*keys, "among")
    once = rows.join(counts.select("g", "word", "bit"), ["g", "word", "bit"], "left_anti").select(*keys, F.lit(0).cast("long").alias("among"))
    placed = once.unionByName(again).join(directory, ["g", "word"])
    lower = "aggregate(filter(coalesce(extra, array()), x -> x.bit < bit), 0L, (a, x) -> a + x.more)"
    pos = F.expr(f"base + bit_count(bits & ~shiftleft(-1L, bit)) + among + {lower}")
    return placed.withColumn("pos", pos).drop("word", "bit", "bits", "base", "among", "extra")


def slot_arrays(nodes: DataFrame, *payload: str) -> DataFrame:
    """(g, block, total, slots): the nodes (g, pos, total and the payload) of
    every 2 ** LEVELS consecutive places, keyed by slot."""
    slot = F.col("pos").bitwiseAND((1 << LEVELS) - 1).cast("int").alias("slot")
    keyed = nodes.select("g", F.shiftright("pos", LEVELS).alias("block"), "total", F.struct(slot, *payload).alias("s"))
    return keyed.groupBy("g", "block").agg(F.first("total").alias("total"), F.collect_list("s").alias("slots"))


def reduce_array(nodes: list[str], total: int) -> list[list[str]]:
    """All levels of one array, the nodes first.  It rises by ``LEVELS``, or
    by as many as bring ``total`` nodes of the group down to one; a node
    without a neighbour is hashed alone."""
    out = [nodes]
    for _ in range(min(LEVELS, max(total - 1, 0).bit_length())):
        below = out[-1]
        out.append([_sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """(side, digest) at each level on the way up from a slot: the sibling is
    left or right (``L``, ``R``) or there is none (``-``, empty digest)."""
    out = []
    for level in levels[:-1]:
        other = slot ^ 1
        out.append(("-", "") if other >= len(level) else ("LR"[other > slot], level[other]))
        slot >>= 1
    return out


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for side, other in path:
        node = _sha(other + node if side == "L" else node + other)
    return node


def _pack(path: list[tuple[str, str]]) -> str:
    return "".join(side + digest for side, digest in path)


def _unpack(text: str) -> list[tuple[str, str]]:
    out, i = [], 0
    while i < len(text):
        size = 0 if text[i] == "-" else 64
        out.append((text[i], text[i + 1 : i + 1 + size]))
        i += 1 + size
    return out


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[dict, list[dict]]]:
    """Rows of a batch and their slots in order of place (put there by key)."""
    slots = batch.column("slots")
    rest = batch.drop_columns(["slots"]).to_pylist()
    for i, row in enumerate(rest):
        listed = slots[i].as_py()
        placed = [None] * len(listed)
        for s in listed:
            placed[s["slot"]] = s
        yield row, placed


def _rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"g": [], "pos": [], "node": [], "total": []}
        for row, placed in _arrays(batch):
            top = reduce_array([s["node"].hex() for s in placed], row["total"])[-1][0]
            for name, value in zip(out, (row["g"], row["block"], bytes.fromhex(top), -(-row["total"] >> LEVELS) if row["total"] > 1 else 1)):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out["g"], pa.string()), pa.array(out["pos"], pa.int64()), pa.array(out["node"], pa.binary()), pa.array(out["total"], pa.int64())], names=list(out))


def climb(arrays: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of all rounds (saved), and the last node (g, node) of every
    group.  A round divides the nodes of a group by 2 ** LEVELS; a group that
    is down to one node passes it on."""
    rounds = [saved(arrays)]
    while True:
        nodes = saved(rounds[-1].mapInArrow(_rise, "g string, pos long, node binary, total long"))
        if (nodes.agg(F.max("total")).first()[0] or 1) == 1:
            return rounds, nodes.select("g", "node")
        rounds.append(saved(slot_arrays(nodes, "node")))


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"g": [], "block": [], "path": [], "top": []}
        for row, placed in _arrays(batch):
            levels = reduce_array([s["node"].hex() for s in placed], row["total"])
            for slot in range(len(placed)):
                out["g"].append(row["g"])
                out["block"].append((row["block"] << LEVELS) + slot)
                out["path"].append(_pack(siblings(levels, slot)) + row["path"])
                out["top"].append(row["top"])
        yield pa.RecordBatch.from_arrays([pa.array(out["g"], pa.string()), pa.array(out["block"], pa.int64()), pa.array(out["path"], pa.string()), pa.array(out["top"], pa.string())], names=list(out))


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(g, block, path, top) for every slot of the lowest of ``rounds``, given
    those of the highest (``above``: block 0 of each group)."""
    for arrays in reversed(rounds):
        above = saved(arrays.join(above, ["g", "block"]).mapInArrow(_hand_down, "g string, block long, path string, top string"))
    return above


def _results(root: str):
    names = ["id", "leaf", "subroot", "root", "path", "proof_sha256", "folded_root"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in names}
            for row, placed in _arrays(batch):
                levels, above = reduce_array([s["node"].hex() for s in placed], row["total"]), _unpack(row["path"])
                for slot, s in enumerate(placed):
                    leaf, path = s["node"].hex(), siblings(levels, slot) + above
                    folded = fold(s["seen"].hex() if s["seen"] is not None else leaf, path)
                    values = (s["id"], leaf, row["top"], root, _pack(path), _sha("".join(d for _, d in path)), folded)
                    for name, value in zip(names, values):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], pa.int64() if n == "id" else pa.string()) for n in names], names=names)

    return emit, "id long, leaf string, subroot string, root string, path string, proof_sha256 string, folded_root string"


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields=FIELDS, observed: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: its id (under the name of ``id_col``),
    ``leaf``, ``subroot`` of its group, ``root``, ``path`` (for each level up
    to the root ``L`` or ``R`` and the digest of the sibling on that side, or
    ``-``), ``proof_sha256`` (of the siblings' digests alone),
    ``folded_root`` (what the path makes of the row as ``observed``: columns
    to read in place of the row's own) and ``verified`` (equals the root).

    Nulls: a null field is framed as ``-``; null ids come before all others,
    the null group before all groups.  Rows of a repeated id stand in order of
    their leaf; equal rows are leaves of their own.  A group of one row has
    its leaf as subroot, a single group its subroot as root; with neither
    siblings nor path the proof is that of the empty text.  An empty table
    gives an empty one.  Ids are integers of up to 64 bits; other columns
    than the fields don't matter and are not returned.

    Texts are hashed where they are read; only digests are shuffled.  The
    driver sees counts and the root.
    """
    prepare(docs.sparkSession)
    rows = saved(_leaves(docs, id_col, group_col, fields, observed or {}))
    if rows.isEmpty():
        empty = rows.select("id", *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "path", "proof_sha256", "folded_root")])
        return empty.withColumn("verified", F.lit(True)).withColumnRenamed("id", id_col)
    placed = ranked(rows).withColumnRenamed("leaf", "node")
    rounds, subroots = climb(slot_arrays(placed, "node", "id", "seen"))
    subroots = saved(subroots)
    groups = global_ranks(subroots, ["g"]).select(F.lit("").alias("g"), (F.col("_rank") - 1).alias("pos"), F.col("_total").alias("total"), "node", F.col("g").alias("group"))
    group_rounds, tops = climb(slot_arrays(saved(groups.drop("group")), "node"))
    root = tops.first()["node"].hex()
    one = docs.sparkSession.createDataFrame([("", 0, "", "")], "g string, block long, path string, top string")
    paths = descend(group_rounds, one).select(F.col("block").alias("pos"), "path")
    above = groups.join(paths, "pos").select(F.col("group").alias("g"), F.lit(0).cast("long").alias("block"), "path", F.lower(F.hex("node")).alias("top"))
    above = descend(rounds[1:], saved(above))
    emit, schema = _results(root)
    out = rounds[0].join(above, ["g", "block"]).mapInArrow(emit, schema)
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", id_col)
