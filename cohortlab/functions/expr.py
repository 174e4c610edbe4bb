"""Column-expression helpers shared by every operator.

All helpers return built-in Spark expressions (no Python UDFs), so they stay
inside whole-stage codegen.  The numeric conventions are chosen so that an
independent SQL engine evaluating the same formula gets bit-identical doubles:

* ``rnd``      — round half away from zero via ``floor(|x|*10^k + 0.5)``.
* ``pct``      — ``100.0 * n / d`` in DOUBLE, NULL when ``d`` is 0.
* ``amount``   — amounts are summed as decimals, exact to 1e-10 and independent
                 of summation order; rounding is left to the output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _rnd_sql(x_sql: str, k: int) -> str:
    p = f"{float(10 ** k)!r}D"
    v = f"CAST(({x_sql}) AS DOUBLE)"
    up = f"CAST(floor(abs({v}) * {p} + 0.5D) AS DOUBLE) / {p}"
    return f"(CAST(CASE WHEN {v} < 0 THEN -({up}) ELSE {up} END + 0.0D AS DOUBLE))"


def _pct_sql(n: str, d: str) -> str:
    return pct_expr_sql(_q(n), _q(d))


def pct_expr_sql(n_sql: str, d_sql: str) -> str:
    """SQL text of ``100.0 * n / d`` in DOUBLE (NULL for a zero denominator)."""
    return f"try_divide(100.0D * CAST(({n_sql}) AS DOUBLE), CAST(({d_sql}) AS DOUBLE))"


def rnd_sql(x_sql: str, k: int | None) -> str:
    """SQL text of :func:`rnd` (identity when ``k`` is None)."""
    return x_sql if k is None else _rnd_sql(x_sql, k)


def _div_sql(n: str, d: str) -> str:
    return f"try_divide(CAST({_q(n)} AS DOUBLE), CAST({_q(d)} AS DOUBLE))"


def rnd_pct(n: str, d: str, k: int) -> Column:
    """``rnd(pct(n, d), k)`` for two column names, built as one expression."""
    return F.expr(_rnd_sql(_pct_sql(n, d), k))


def rnd_div(n: str, d: str, k: int) -> Column:
    """``rnd(div(n, d), k)`` for two column names, built as one expression."""
    return F.expr(_rnd_sql(_div_sql(n, d), k))


def rnd(x, k: int = 2) -> Column:
    """Round half away from zero to ``k`` decimals (NULL stays NULL).

    A column name is turned into a single SQL expression (one JVM round trip
    while the plan is built); a Column is composed with Column operators.
    """
    if isinstance(x, str):
        return F.expr(_rnd_sql(_q(x), k))
    x = col(x).cast("double")
    p = float(10 ** k)
    up = F.floor(F.abs(x) * p + 0.5).cast("double") / p
    return (F.when(x < 0, -up).otherwise(up) + F.lit(0.0)).cast("double")


def shown(x, k: int | None) -> Column:
    """:func:`rnd` for presentation; the DOUBLE as it is when ``k`` is None."""
    return col(x).cast("double") if k is None else rnd(x, k)


def div(n, d) -> Column:
    """``n / d`` as DOUBLE; NULL when ``d`` is 0 or NULL (no ANSI error)."""
    return F.try_divide(col(n).cast("double"), col(d).cast("double"))


def pct(n, d) -> Column:
    """``100.0 * n / d`` as DOUBLE, NULL when ``d`` is 0."""
    return F.try_divide(F.lit(100.0) * col(n).cast("double"), col(d).cast("double"))


def safe_pct(n, d) -> Column:
    """Percentage that is 0.0 (not NULL) for a zero denominator."""
    return F.coalesce(pct(n, d), F.lit(0.0))


def flag(cond: Column) -> Column:
    """0/1 integer flag from a boolean condition (NULL → 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def amount(x) -> Column:
    """Money amount as DECIMAL(28,10): its sum is DECIMAL(38,10) and exact."""
    return col(x).cast("decimal(28,10)")


def plain(x) -> Column:
    """A decimal amount (or a sum of amounts) as DOUBLE."""
    return col(x).cast("double")


def month_key(d) -> Column:
    """'YYYY-MM' period key."""
    return F.date_format(col(d), "yyyy-MM")


def month_index(d) -> Column:
    """Months since year 0: ``year*12 + month`` (BIGINT)."""
    return (F.year(col(d)).cast("long") * 12 + F.month(col(d)).cast("long"))


def week_number_monday(d) -> Column:
    """Week of year 00–53 where weeks start on Monday and the days before the
    first Monday are week 0 (C ``%W``; not ISO)."""
    d = col(d)
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def week_key(d) -> Column:
    """'YYYY-Www' key with a Monday-based week number (``%Y-W%W``)."""
    return F.format_string("%04d-W%02d", F.year(col(d)), week_number_monday(d))


def day_offset(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` (BIGINT)."""
    return F.datediff(col(later), col(earlier)).cast("long")
