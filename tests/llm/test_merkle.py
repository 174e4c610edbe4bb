import hashlib
import random
import zlib

import pytest
from llm_fixtures import clashing
from pyspark.sql import functions as F

from cohortlab.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((None, "") if i ^ 1 >= len(level) else ("L" if i & 1 else "R", level[i ^ 1]))
        i //= 2
    return out


def brute(rows):
    by = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
        by.setdefault(r[2], []).append((r[0], leaf(r), leaf((*r[:3], r[3] + 1, r[4])) if hit else leaf(r)))
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups:
        by[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [tree([x[1] for x in by[g]]) for g in groups]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(groups):
        for i, (doc, own, seen) in enumerate(by[g]):
            path, node = siblings(trees[k], i) + siblings(top, k), seen
            for side, other in path:
                node = sha(other, node) if side == "L" else sha(node, other)
            out.append((doc, own, trees[k][-1][0], top[-1][0], sha(*[s for _, s in path]), node, node == top[-1][0]))
    return sorted(map(repr, out))


def manifest(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return M.merkle_manifest(docs, observed={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


def result(df):
    rows = df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted(repr(tuple(r)) for r in rows)


def messy(n):
    rnd = random.Random(n)
    ids = lambda: rnd.choice([None, 7, 7, -3, rnd.randrange(-(10**18), 10**18), rnd.randrange(3000), -(2**63), 2**63 - 1])
    return [(ids(), rnd.choice(["a", None]), rnd.choice(["en"] * 8 + ["de", None, "fr", "ü", ""]), rnd.choice([None, 5, rnd.randrange(99)]), rnd.choice([None, "", "é text"])) for _ in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        messy(900),
        messy(1),
        [(i, "a", "en", 1, "x") for i in range(257)] + [(5, "b", "de", 1, "y")],
        [(3, "a", "en", 1, "same")] * 300,
        [(0, "a", None, 1, "t " * 60000)],
    ],
    ids=["nulls, repeats, far ids", "one row", "one more than an array", "one row many times", "long text, no group"],
)
def test_against_brute_force(spark, rows):
    assert result(manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, "a", "en", 1, "x") for i in range(20)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA), "leaf", "root", "g", "pos", "word", "slots", "total", "path")
    assert result(manifest(docs)) == brute(rows)


def test_three_rounds_of_arrays(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 8)
    rows = [(i * 3, "a", "en", i, str(i)) for i in range(66000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = M.merkle_manifest(docs).filter("doc_id % 997 = 0").collect()
    assert {r.root for r in got} == {tree([leaf(r) for r in rows])[-1][0]}
    assert all(r.verified and M.fold(r.leaf, M._unpack(r.path)) == r.root for r in got)


def test_directory_ranks_words_over_several_levels(spark):
    rnd = random.Random(4)
    ids = sorted({rnd.choice([rnd.randrange(500), rnd.randrange(10**7), rnd.randrange(-(10**15), 10**15)]) for _ in range(3000)})
    rows = spark.createDataFrame([("=g", i, b"", None) for i in ids], "g string, id long, leaf binary, seen binary")
    got = {r.id: (r.pos, r.total) for r in M.ranked(M.saved(rows)).collect()}
    assert got == {i: (k, len(ids)) for k, i in enumerate(ids)}


def test_reduce_array_rises_by_what_the_group_needs():
    nodes = [sha(str(i)) for i in range(5)]
    assert M.reduce_array(nodes, 5)[-1] == tree(nodes)[-1]
    assert len(M.reduce_array(nodes[:1], 1)) == 1
    assert len(M.reduce_array(nodes[:1], 257)) == 9  # the last array of a group of two: rises with the other
