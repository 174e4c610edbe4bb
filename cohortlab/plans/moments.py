"""Mergeable moments: count, sum, sum of squares and co-products, exact.

Values are taken as DECIMAL(18,8) and their products as DECIMAL(38,16), so
every sum is exact and does not depend on the order of addition: moments of
slices, days or arms can be kept and added up later, and what is taken from
them at the end is the same to the last bit however the rows were dealt.  The
last step, one row a group, is done in exact fractions, so a spread that is
small beside the mean is not lost either.  Values of 1e10 and more are an
error, not a wrong result.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact(x) -> Column:
    """A value as DECIMAL(18,8)."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(18,8)")


def sums(x, prefix: str = "") -> list[Column]:
    """Aggregates ``n``, ``s1`` and ``s2`` of a value; nulls don't count."""
    v = exact(x)
    return [F.count(v).alias(f"{prefix}n"), F.sum(v).alias(f"{prefix}s1"), F.sum(v * v).alias(f"{prefix}s2")]


def co_sums(x, y, prefix: str = "") -> list[Column]:
    """Aggregates of a pair over the rows that have both: ``n``, ``sx``,
    ``sy``, ``sxx``, ``syy``, ``sxy``."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, exact(x)), F.when(both, exact(y))
    out = {"n": F.count(a), "sx": F.sum(a), "sy": F.sum(b), "sxx": F.sum(a * a), "syy": F.sum(b * b), "sxy": F.sum(a * b)}
    return [c.alias(prefix + k) for k, c in out.items()]


def merged(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of slices added up by ``keys``: every other column is a sum."""
    rest = [c for c in moments.columns if c not in keys and c in ("n", "s1", "s2", "sx", "sy", "sxx", "syy", "sxy")]
    return moments.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])


def _rows(*columns: pa.Array):
    return zip(*(c.to_pylist() for c in columns))


def variance(ddof: int) -> Column:
    """Variance from the columns ``n``, ``s1``, ``s2``; null for ``ddof``
    values or fewer."""

    @F.arrow_udf("double")
    def from_sums(n: pa.Array, s1: pa.Array, s2: pa.Array) -> pa.Array:
        out = []
        for k, a, b in _rows(n, s1, s2):
            out.append(float((Fraction(b) - Fraction(a) ** 2 / k) / (k - ddof)) if k is not None and k > ddof else None)
        return pa.array(out, pa.float64())

    return from_sums(F.col("n"), F.col("s1"), F.col("s2"))


def correlation(prefix: str = "") -> Column:
    """Pearson correlation from the columns of :func:`co_sums`; null for fewer
    than one pair, NaN without spread (0 / 0, as Spark's ``corr``)."""

    @F.arrow_udf("double")
    def from_sums(n: pa.Array, sx: pa.Array, sy: pa.Array, sxx: pa.Array, syy: pa.Array, sxy: pa.Array) -> pa.Array:
        out = []
        for k, x, y, xx, yy, xy in _rows(n, sx, sy, sxx, syy, sxy):
            if not k:
                out.append(None)
                continue
            x, y, xx, yy, xy = map(Fraction, (x, y, xx, yy, xy))
            spread = (k * xx - x * x) * (k * yy - y * y)
            # the root of an exact square: the sign and size come from exact numbers
            co = k * xy - x * y
            out.append(float("nan") if not spread else (1 if co >= 0 else -1) * float(co * co / spread) ** 0.5)
        return pa.array(out, pa.float64())

    return from_sums(*[F.col(prefix + c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
