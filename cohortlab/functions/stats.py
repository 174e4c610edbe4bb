"""Statistical tails evaluated on already-aggregated rows.

The test statistics themselves (z, t, Welch degrees of freedom) are built-in
column expressions computed on the one-row-per-comparison aggregate; only the
distribution tail needs code Spark does not ship.  It runs as an Arrow-batched
pandas UDF over that tiny aggregate, never over raw events.

Normal tail: ``erfc``.  Student-t tail: the regularised incomplete beta
function evaluated by its continued fraction (Lentz's method), as given in
standard numerical-methods texts.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_two_tailed_p(z: float) -> float:
    """Two-sided p-value of a standard-normal statistic."""
    if z is None or (isinstance(z, float) and math.isnan(z)):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


def _betacf(a: float, b: float, x: float) -> float:
    max_iter, eps, tiny = 300, 3e-16, 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1.0 / d
    h = d
    for m in range(1, max_iter + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def regularized_incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def student_t_two_tailed_p(t: float, df: float) -> float:
    """Two-sided p-value of a Student-t statistic with ``df`` degrees of freedom."""
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    x = df / (df + t * t)
    return regularized_incomplete_beta(df / 2.0, 0.5, x)


@F.pandas_udf(T.DoubleType())
def normal_p_udf(z: pd.Series) -> pd.Series:
    return z.map(lambda v: normal_two_tailed_p(float(v)) if pd.notna(v) else None)


@F.pandas_udf(T.DoubleType())
def student_t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [student_t_two_tailed_p(float(a), float(b)) if pd.notna(a) and pd.notna(b) else None for a, b in zip(t, df)]
    )


def significance_label(p: Column) -> Column:
    """Verdict from a p-value, strict thresholds 0.01 / 0.05 / 0.10."""
    # Verdict texts and thresholds of the p-value vocabulary.
    return (
        F.when(p < 0.01, F.lit("Significant at 99% confidence (p < 0.01)"))
        .when(p < 0.05, F.lit("Significant at 95% confidence (p < 0.05)"))
        .when(p < 0.10, F.lit("Significant at 90% confidence (p < 0.10)"))
        .otherwise(F.lit("Not statistically significant (p >= 0.10)"))
    )


def z_verdict(z: Column) -> Column:
    """Verdict from a z statistic, inclusive critical values 2.576 / 1.96 / 1.645."""
    # Verdict texts and two-tailed critical values of the z vocabulary.
    az = F.abs(z)
    return (
        F.when(az >= 2.576, F.lit("Significant at 99% CI"))
        .when(az >= 1.96, F.lit("Significant at 95% CI"))
        .when(az >= 1.645, F.lit("Significant at 90% CI"))
        .otherwise(F.lit("Not statistically significant"))
    )
