"""Benchmark decontamination: MinHash containment search of short test items
inside long documents, verified by exact shingle containment.

The set that is searched for is the small one, so a signature of the item must
be found inside the document's set: items are partitioned by size, and an item
of ``n`` shingles is indexed under its ``k`` smallest shingle hashes (a
bottom-k MinHash), where ``k`` is one more than the number of shingles that a
document may lack in the item's size class.  A document that holds the asked
share of the item therefore holds at least one of the ``k``: the search loses
nothing.  The documents are scanned where they lie; each hit is verified on
the words themselves.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, prepare, show

SHINGLE = 5
CONTAINMENT = 0.8
MAX_BROADCAST_BYTES = 32 << 20  # of item texts at once; more items are searched block by block
WORD = re.compile(r"\w+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def item_words(text: str | None) -> list[str]:
    """Words (letters, digits, _) in lower case."""
    return WORD.findall(text.lower()) if text else []


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:  # a cache only
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[str], size: int, cache: dict[str, int]) -> np.ndarray:
    """64-bit hashes of the shingles in order; a shorter text is one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((cache[w] for w in words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(size, len(words))):
        out = (out ^ h[i : i + n]) * _MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


def shingles(words: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def allowed_misses(n: int, containment: float) -> int:
    """Most shingles of ``n`` that may be absent."""
    return n - math.ceil(containment * n - 1e-9)


class ItemIndex:
    """Items under their smallest hashes, by size class (powers of two)."""

    def __init__(self, items: list[tuple[int, str | None]], size: int, containment: float):
        cache = _WordHashes()
        self.size, self.containment = size, containment
        self.items: dict[int, set[tuple[str, ...]]] = {}
        self.least: dict[int, int] = {}
        postings = defaultdict(list)
        for at, (_, text) in enumerate(items):
            words = item_words(text)
            hashes = np.unique(shingle_hashes(words, size, cache))
            if not len(hashes):
                continue
            self.items[at] = shingles(words, size)
            upper = (1 << len(hashes).bit_length()) - 1  # of its size class
            k = min(len(hashes), allowed_misses(upper, containment) + 1)
            self.least[at] = math.ceil(containment * len(self.items[at]) - 1e-9)
            for h in hashes[:k]:
                postings[int(h)].append(at)
        self.ids = [i for i, _ in items]
        self.keys = np.array(sorted(postings), np.uint64)
        self.postings = [postings[int(h)] for h in self.keys]

    def search(self, text: str | None, cache: dict[str, int]) -> list[tuple[int, float]]:
        """(item id, containment) of the items that a text holds."""
        words = item_words(text)
        if not words or not len(self.keys):
            return []
        hashes = shingle_hashes(words, self.size, cache)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = np.unique(at[self.keys[at] == hashes])
        found = {i for p in hit for i in self.postings[p]}
        # a text with fewer shingles than the item needs can't hold it; an item shorter than a shingle is looked for as a phrase
        out = []
        own = shingles(words, self.size) if found else set()
        for i in sorted(found):
            if len(own) >= self.least[i]:
                share = len(self.items[i] & own) / len(self.items[i])
                if share >= self.containment - 1e-9:
                    out.append((self.ids[i], share))
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``most`` bytes of text, one after the other."""
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("t is not null")
    n = max(1, math.ceil((rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) / most))
    for b in range(n):
        block = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else rows
        yield [(r["i"], r["t"]) for r in block.orderBy("i", "t").collect()]


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` with ``items`` (ids of the items whose shingles a document
    holds to at least ``containment``, ascending) and ``containment`` (the
    largest share, 0 if none); input columns of these names are replaced.

    Null or word-less documents and items match nothing; repeated rows are
    judged alike; an item of fewer words than a shingle counts as one shingle,
    which only a text of just these words holds.  The items are broadcast in
    blocks of at most ``max_bytes`` of text, and the documents are scanned
    once for each block, so a large benchmark costs time, not memory.
    """
    prepare(docs.sparkSession)
    kind = items.schema[item_id].dataType.simpleString()

    def searcher(index):
        @F.pandas_udf(f"array<struct<item:{kind},share:double>>")
        def search(texts: pd.Series) -> pd.Series:
            cache = _WordHashes()
            return pd.Series([[{"item": i, "share": s} for i, s in index.value.search(t, cache)] for t in texts])

        return search(F.col(names[text_col]))

    spark = docs.sparkSession
    docs, names = hide(docs)
    found = [searcher(spark.sparkContext.broadcast(ItemIndex(block, shingle, containment))) for block in _blocks(items, item_id, item_text, max_bytes)]
    out = docs.withColumn("_found", F.concat(*found))
    best = F.coalesce(F.array_max(F.col("_found.share")), F.lit(0.0))
    out = out.withColumns({"items": F.array_sort(F.array_distinct(F.col("_found.item"))), "containment": best})
    return show(out, names, "items", "containment")


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold an item; columns as given."""
    hidden, names = hide(docs)
    options["text_col"] = names[options.get("text_col", "text")]
    return show(contaminated(hidden, items, **options).filter(F.size("items") == 0), names)
