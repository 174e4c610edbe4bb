"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked when
they differ in few bits, by bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits agree on some two of
``radius + 2`` bit pieces (at most ``radius`` pieces can differ), so they meet
in a block of equal value in one pair of pieces.  Blocks are compared whole: bit plane
``b`` of a block is one integer with a bit for each of its fingerprints.  For
one fingerprint, the planes' differences are added into bitwise carry-save
counters, which updates the distances to the whole block with a few integer
operations; the block is abandoned as soon as all its counters have passed the
radius.  A block reports its links as a forest (as many links as members, not
all pairs).  Blocks above ``tile`` members are cut into parts by hash and
compared part against part in separate rows, so no task holds a whole hot
block.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, matching, prepare, release, saved, show
from cohortlab.llm.graph import component_labels

RADIUS = 3
SHINGLE = 3
TILE = 1024
SEED = 42
# bits set in each byte value, lowest first
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit integer.

    A-Z are lower-cased; words are runs without ASCII white space; shingles
    (repeats included) are hashed with XXH64, seed 42.  A text with fewer
    words is one shingle; a null text or one without words has fingerprint 0.
    """
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h64 = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((h64(g, SEED) for g in grams), np.uint64, n)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = 0
    for k in range(8):
        ones = np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS
        for b in range(8):
            if 2 * int(ones[b]) > n:
                out |= 1 << (8 * k + b)
    return out - (1 << 64) if out >> 63 else out


def bit_planes(values: np.ndarray) -> list[int]:
    """Plane ``b``: an integer whose bit ``r`` is bit ``b`` of value ``r``."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits, axis=0, bitorder="little")
    return [int.from_bytes(packed[:, b].tobytes(), "little") for b in range(64)]


def within_radius(planes: list[int], value: int, alive: int, full: int, radius: int = RADIUS) -> int:
    """Mask of the ``alive`` members within ``radius`` bits of ``value``."""
    width = radius.bit_length()
    start = (1 << width) - 1 - radius  # so that a counter overflows just beyond the radius
    counters = [full if start >> i & 1 else 0 for i in range(width)]
    for b in range(64):
        carry = planes[b] ^ full if value >> b & 1 else planes[b]
        for i in range(width):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        alive &= ~carry
        if not alive:
            return 0
    return alive


def block_links(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links of a block of distinct fingerprints (signed) as a forest: each
    linked member with the smallest member it reaches inside the block."""
    values = np.unique(values)
    m = len(values)
    planes, full = bit_planes(values.view(np.uint64)), (1 << m) - 1
    root = list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    unsigned = [int(x) for x in values.view(np.uint64)]
    for i in range(m - 1):
        near = within_radius(planes, unsigned[i], (full >> (i + 1)) << (i + 1), full, radius)
        while near:
            low = near & -near
            a, b = find(i), find(low.bit_length() - 1)
            root[max(a, b)] = min(a, b)
            near ^= low
    return [(int(values[i]), int(values[find(i)])) for i in range(m) if find(i) != i]


def piece_masks(radius: int = RADIUS) -> list[int]:
    """Bit masks (signed) of all pairs of ``radius + 2`` pieces of 64 bits."""
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    pieces = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [a | b for a, b in combinations(pieces, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (column fp) -> forest of links (u, v)."""
    spark = prepare(prints.sparkSession)
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(piece_masks(radius))]
    keyed = prints.select("fp", F.explode(F.array(*keys)).alias("b")).select("fp", "b.t", "b.k")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / tile).cast("int")
    rows = keyed.join(sizes, ["t", "k"]).withColumn("parts", parts)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # a part meets every other part once; the members of a part meet in any of its tiles
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("parts = 1 or other <> own")
    tiles = rows.groupBy("t", "k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).agg(F.collect_list("fp").alias("members"))

    def compare(batches):
        for batch in batches:
            found = [x for m in batch["members"] for x in block_links(np.asarray(m, np.int64), radius)]
            yield pd.DataFrame({"u": pd.Series([x[0] for x in found], dtype="int64"), "v": pd.Series([x[1] for x in found], dtype="int64")})

    return tiles.select("members").mapInPandas(compare, "u long, v long")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": pd.Series([fingerprint(t, shingle) for t in b["text"]], dtype="int64")})

    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "doc_id string, fp long").withColumn("doc_id", F.col("doc_id").cast(kind))


def labelled(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """(fp, least, label of the component) from rows (fp, least) of distinct
    fingerprints."""
    prints = saved(prints)
    labels = component_labels(links(prints.select("fp"), radius, tile))
    out = saved(prints.join(labels, prints["fp"] == labels["u"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label")))
    release(prints, labels)
    return out


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) for every row.

    component_id: the smallest doc_id reachable over links of at most
    ``radius`` bits, itself included.  Rows of equal fingerprint are one class
    and are compared once; repeated rows get one result row each.  Null or
    word-less texts have fingerprint zero and link like any other.  A null
    doc_id joins its class, but is its smallest only if there is no other.
    Empty table: no rows.  Columns other than id and text are not read.
    """
    docs = saved(fingerprints(docs, shingle, id_col, text_col))
    classes = labelled(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), radius, tile)
    smallest = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = saved(classes.join(smallest, "label").select("fp", "component_id"))
    release(classes)
    out = docs.join(by_print, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with
    the smallest id, null ids last, and of those the one with the smallest md5
    of its text (of rows that share both, one).  Groups are told by their
    component, not by an id, so each keeps its document if ids are null or
    used again."""
    kind = docs.schema[id_col].dataType
    marked = docs.select(F.to_json(F.struct(F.col(id_col).cast("string").alias("i"), F.md5(text_col).alias("m"))).alias("doc_id"), F.col(text_col).alias("text"))
    prints = fingerprints(marked, shingle).select("fp", F.from_json("doc_id", "i string, m string").alias("d"))
    own_id = F.col("d.i").cast(kind)
    prints = saved(prints.select("fp", F.struct(own_id.isNull().alias("nameless"), own_id.alias("i"), F.col("d.m").alias("m")).alias("d")))
    classes = labelled(prints.groupBy("fp").agg(F.min("d").alias("least")), radius, tile)
    by_print = classes.join(classes.groupBy("label").agg(F.min("least").alias("keep")), "label").select("fp", "keep")
    # rows of an id and a text share fate and fingerprint; only those that must go or repeat are named
    rows = prints.groupBy("fp", "d").agg(F.count(F.lit(1)).alias("n")).join(by_print, "fp")
    gone = saved(rows.filter("not d <=> keep").select("d.i", "d.m"))
    repeated = saved(rows.filter("d <=> keep and n > 1").select("d.i", "d.m"))
    release(prints, classes)
    docs, names = hide(docs)
    docs = docs.withColumns({"i": F.col(names[id_col]), "m": F.md5(names[text_col])})
    kept = matching(docs, gone, ["i", "m"], "left_anti")
    if repeated.isEmpty():
        return show(kept, names)
    once = matching(kept, repeated, ["i", "m"]).dropDuplicates(["i", "m"])
    return show(matching(kept, repeated, ["i", "m"], "left_anti").unionByName(once), names)
