"""Exact quantiles by radix selection.

Values are mapped to 64-bit integers that have the order of the doubles.  A
pass counts, with one partial aggregate, how many values of a group fall into
each of the 4,096 classes of the next twelve bits; the counts say which class
holds a wanted rank, and the next pass looks only at values of that class.
After at most six passes, usually two or three, a class holds a single value.
No value is sorted, shuffled or stored: what moves is one small histogram a
pass and group, however many rows a group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.plans.scale import drop_staged, staged

#: Bits that one pass narrows down; 64 = 5 * 12 + 4.
PASS_BITS = 12


def ordered_bits(x: Column) -> Column:
    """A long that is ordered like the double ``x``: the exponent and mantissa
    of its magnitude (the IEEE 754 bits), negative for negative numbers.  Zeros are
    equal, NaN is above infinity, as Spark orders them; null stays null."""
    a = F.abs(x)
    # powers of two are exact, so is dividing by them; log2 may be off by one at a power
    e = F.floor(F.log2(a)).cast("int")
    power = lambda k: F.pow(F.lit(2.0), k.cast("double"))
    e = F.when(power(e) > a, e - 1).when(a / power(e) >= 2.0, e + 1).otherwise(e)
    two52 = float(1 << 52)
    normal = F.shiftleft((e + 1023).cast("long"), 52) + ((a / power(e) - 1.0) * two52).cast("long")
    tiny = (a * float(2.0**1022) * two52).cast("long")
    infinite = F.lit(2047 << 52).cast("long")
    size = (
        F.when(a == 0.0, F.lit(0).cast("long")).when(a < 2.2250738585072014e-308, tiny)
        .when(F.isnan(a), infinite + 1).when(a == float("inf"), infinite).otherwise(normal)
    )
    return F.when(x < 0, -size).otherwise(size)


def select_ranks(values: DataFrame, ranks: DataFrame, groups: list[str]) -> DataFrame:
    """The values at given places of the ascending order of a group.

    ``values``: group columns and ``_v`` (double, not null).  ``ranks``: group
    columns, ``_t`` (any label) and ``_r`` (place from 0, below the size of
    the group).  Returns group columns, ``_t`` and ``_v``."""
    keyed = values.withColumn("_k", ordered_bits(F.col("_v")))
    shift, step = 64 - PASS_BITS, None  # bits below this pass's classes; bits by which they refine the last ones
    wanted = ranks.select(*groups, "_t", "_r", F.lit(None).cast("long").alias("_p"))
    done, used = [], []
    inside = keyed
    while True:
        counts = inside.withColumn("_c", F.shiftright("_k", shift)).groupBy(*groups, "_c").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        # the classes of one pass within a group and class of the pass before are at most 2 ** PASS_BITS rows
        counts = staged(counts.withColumn("_p", F.shiftright("_c", step) if step else F.lit(None).cast("long")))
        used.append(counts)
        before = Window.partitionBy(*groups, "_p").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        classes = counts.withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        found = _null_safe_join(wanted, classes, [*groups, "_p"]).filter("_r >= _b AND _r < _b + _n")
        found = staged(found.select(*groups, "_t", (F.col("_r") - F.col("_b")).alias("_r"), F.col("_c").alias("_p"), "_lo", "_hi"))
        used.append(found)
        single = F.col("_lo").eqNullSafe(F.col("_hi"))
        done.append(found.filter(single).select(*groups, "_t", F.col("_lo").alias("_v")))
        wanted = found.filter(~single).select(*groups, "_t", "_r", "_p")
        if wanted.isEmpty():
            break
        classes_left = wanted.select(*groups, "_p").distinct()
        inside = _null_safe_join(keyed.withColumn("_p", F.shiftright("_k", shift)), classes_left, [*groups, "_p"]).drop("_p")
        step = min(PASS_BITS, shift)
        shift -= step
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = staged(out)
    for frame in used:
        drop_staged(frame)
    return out


def _null_safe_join(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    right = b.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in b.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return a.join(right, cond).drop(*[f"_on_{c}" for c in on])


def selected_quantiles(df: DataFrame, value_col: str, probs, group_cols=()) -> DataFrame:
    """Exact quantiles with linear interpolation (place ``(n - 1) * p``) per
    group, nulls ignored: group columns, ``_n`` (values), ``q0``, ``q1``, ...
    in the order of ``probs``.  Like ``exact_quantiles``, without sorting."""
    groups = list(group_cols)
    vals = df.select(*groups, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    sizes = staged(vals.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0"))
    place = lambda p: (F.col("_n") - 1).cast("double") * float(p)
    marks = [F.struct(F.lit(f"{side}{i}").alias("_t"), f(place(p)).cast("long").alias("_r")) for i, p in enumerate(probs) for side, f in (("lo", F.floor), ("hi", F.ceil))]
    got = select_ranks(vals, sizes.select(*groups, F.inline(F.array(*marks))), groups)
    wide = got.groupBy(*groups).agg(*[F.max(F.when(F.col("_t") == f"{s}{i}", F.col("_v"))).alias(f"_{s}{i}") for i in range(len(probs)) for s in ("lo", "hi")])
    out = _null_safe_join(sizes, wide, groups) if groups else sizes.join(F.broadcast(wide))
    quantiles = [(F.col(f"_lo{i}") + F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), 0.0).otherwise((F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (place(p) - F.floor(place(p)).cast("double")))).alias(f"q{i}") for i, p in enumerate(probs)]
    return out.select(*groups, "_n", *quantiles)
