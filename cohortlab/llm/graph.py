"""Connected components of an edge table, fully distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import release, saved


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def component_labels(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: longs) -> (u, label): the smallest node reachable, for
    every node but the smallest of its component.

    Alternating large and small stars (each node is re-linked to the smallest
    node it knows of) until the edges stay as they are, which takes a number
    of rounds that grows with the logarithm of the largest component.  Every
    round is written to the shared folder; only its row count and checksum
    reach the driver.  Self links are ignored; no edges, no rows.
    """
    e = saved(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    mark = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark or now[0] == 0:
            return e.select("u", F.col("v").alias("label"))
        mark = now
        before, e = e, saved(_small_star(_large_star(e)))
        release(before)
