"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the budget in proportion to its weight, but at
most ``max_epochs`` times its size; what is cut off is shared again by weight
among the others until no target is above its cap.  A source whose target is
``r`` times its size is taken ``floor(r)`` times as a whole, and once more in
part: its documents in a seeded random order up to the rest of the target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, n_words, prepare, saved, show
from cohortlab.plans.scale import global_ranks

WEIGHT_CYCLE = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 20240607
_BUCKET_HEX = 3  # 4096 buckets of the seeded order


def cyclic_weights(sources: DataFrame, weights=WEIGHT_CYCLE) -> DataFrame:
    """``sources`` (one row each, column source) with ``weight``: the given
    weights repeated over the sources by code point, null last."""
    ranked = global_ranks(sources, [F.col("source").asc_nulls_last()])
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", w).drop("_rank", "_total")


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``.

    The level starts at budget / weights.  Each round clamps the sources whose
    share is above ``max_epochs`` times their size and lifts the level for the
    others; the clamped set only grows, so it ends.  Only the level and two
    sums reach the driver.  If all are clamped the budget can't be met and
    every target is its cap.  Empty input or zero sizes: targets of zero.
    """
    cap = F.col("source_size") * float(max_epochs)
    total = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        clamped = F.lit(False) if level is None else cap <= F.col("weight") * level
        fixed, weight = sources.agg(F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, F.col("weight")))).first()
        now = (total - (fixed or 0.0)) / weight if weight else math.inf
        if now == level or math.isinf(now):
            level = now
            break
        level = now
    return sources.withColumn("target", cap if math.isinf(level) else F.least(cap, F.col("weight") * level))


def _source_key(source: str) -> Column:
    return F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source)))


def _order_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def mixing_plan(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHT_CYCLE, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, weight, target, whole (times
    every document is taken) and last_key: documents whose seeded key is at
    most last_key are taken once more (null: none).

    Sizes are pre-aggregated by source and bucket of the seeded order; only
    the one bucket of a source in which its quota ends (a 4096th of it) is
    ordered row by row, so a source with a third of all rows is no hot task.
    A document is in the extra part if more than half of it lies before the
    quota: the source is off its target by half a document at most.  Rows with
    the same id have one key and stay or go together.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), _order_key(id_col, seed).alias("key"))
    rows = saved(rows.withColumn("bucket", F.substring("key", 1, _BUCKET_HEX)))
    buckets = saved(rows.groupBy("source", "bucket").agg(F.sum("size").alias("n")))
    sources = buckets.groupBy("source").agg(F.sum("n").alias("source_size"))
    plan = saved(water_fill(saved(cyclic_weights(sources, weights)), share, max_epochs))
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("_quota", F.col("target") - F.col("whole") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = buckets.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    last = filled.join(plan.select(F.col("source").alias("_s"), "_quota"), F.col("source").eqNullSafe(F.col("_s")))
    last = last.filter((F.col("_quota") > F.col("_before")) & (F.col("_quota") <= F.col("_before") + F.col("n")))
    last = last.select("_s", F.col("bucket").alias("_b"), "_before", "_quota")
    units = rows.join(last, rows["source"].eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    units = units.groupBy("_s", "_b", "key").agg(F.sum("size").alias("size"), F.first("_before").alias("_before"), F.first("_quota").alias("_quota"))
    running = Window.partitionBy("_s", "_b").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    units = units.withColumn("_mid", F.col("_before") + F.sum("size").over(running) - F.col("size") / 2)
    # none of its documents is in: the bucket's own prefix lies after all buckets before it and before its documents
    ends = units.groupBy(F.col("_s"), F.col("_b")).agg(F.coalesce(F.max(F.when(F.col("_mid") < F.col("_quota"), F.col("key"))), F.first("_b")).alias("last_key"))
    out = plan.join(ends.select("_s", "last_key"), plan["source"].eqNullSafe(F.col("_s")), "left")
    return saved(out.select("source", "source_size", "weight", "target", "whole", "last_key"))


def with_takes(docs: DataFrame, plan: DataFrame, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with source_size, target and ``times`` (how often the mix has
    the document).  ``plan`` has one row per source; Spark broadcasts it if
    its known size allows, else it splits large sources in the join."""
    p = plan.select(F.col("source").alias("_s"), "source_size", "target", "whole", "last_key")
    p = p.withColumn("_sk", _source_key("_s")).drop("_s")
    docs, names = hide(docs)
    keyed = docs.withColumn("_sk", _source_key(names[source_col]))
    joined = keyed.join(p, "_sk", "left")
    extra = F.coalesce((_order_key(names[id_col], seed) <= F.col("last_key")).cast("long"), F.lit(0))
    return show(joined.withColumn("times", F.col("whole") + extra), names, "source_size", "target", "times")


def mix(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mixed collection: every document as often as the mix takes it, with
    ``copy`` (1, 2, ...).  Nulls: a null source is a source of its own, a null
    text has no words, a null id has the key of ''.  Documents without words
    follow their source's rule.  An input column ``copy`` is replaced."""
    plan = mixing_plan(docs, seed, **options)
    hidden, names = hide(docs)
    keys = [F.col(names[c]).alias(c) for c in ("doc_id", "source")]
    taken = with_takes(hidden.select("*", *keys), plan, seed).filter("times > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
    return show(taken.select(*names.values(), copies.alias("copy")), names, "copy")
