"""Oracle SQL — experiments (X1–X13).

One row with a FILTER aggregate per arm; variances by the engine's own
var_pop / var_samp; tails of the normal and Student distributions by Simpson's
rule over the density.
"""

from sql_oracle.bindings import PCT, R, WEEK

X1 = f"""
SELECT experiment_group, COUNT(*) AS users, count_if(converted)::BIGINT AS converted_users,
       {R(PCT('count_if(converted)', 'COUNT(*)'), 2)} AS conversion_rate_pct
FROM app_experiments GROUP BY ALL
"""

#: One row: sizes, conversions, shares of the arms (c, t), and z of their difference under the pooled share.
_BOTH = """
arm AS (
    SELECT count(*) FILTER (experiment_group = 'control') AS nc, count(*) FILTER (experiment_group = 'treatment') AS nt,
           count(*) FILTER (experiment_group = 'control' AND converted) AS kc, count(*) FILTER (experiment_group = 'treatment' AND converted) AS kt,
           avg(converted::INT::DOUBLE) FILTER (experiment_group = 'control') AS c,
           avg(converted::INT::DOUBLE) FILTER (experiment_group = 'treatment') AS t,
           avg(converted::INT::DOUBLE) FILTER (experiment_group IN ('control', 'treatment')) AS pool
    FROM app_experiments
),
test AS (
    SELECT *, (t - c) / nullif(sqrt(pool * (1 - pool) * (1 / nc::DOUBLE + 1 / nt::DOUBLE)), 0) AS z FROM arm
)"""

# Verdict texts and critical values.
_BY_Z = """CASE WHEN abs(z) >= 2.576 THEN 'Significant at 99% CI' WHEN abs(z) >= 1.96 THEN 'Significant at 95% CI'
            WHEN abs(z) >= 1.645 THEN 'Significant at 90% CI' ELSE 'Not statistically significant' END"""
_BY_P = """CASE WHEN p < 0.01 THEN 'Significant at 99% confidence (p < 0.01)' WHEN p < 0.05 THEN 'Significant at 95% confidence (p < 0.05)'
            WHEN p < 0.10 THEN 'Significant at 90% confidence (p < 0.10)' ELSE 'Not statistically significant (p >= 0.10)' END"""

X2 = (
    _BOTH
    + f"""
SELECT {R('100 * c', 2)} AS control_conversion_pct, {R('100 * t', 2)} AS treatment_conversion_pct,
       {R('100 * (t - c)', 2)} AS absolute_uplift_pp, {R('100 * (t - c) / nullif(c, 0)', 1)} AS relative_uplift_pct,
       nc AS control_n, nt AS treatment_n
FROM test
"""
)

X4 = (
    _BOTH
    + f"""
SELECT {R('100 * c', 2)} AS control_rate_pct, {R('100 * t', 2)} AS treatment_rate_pct,
       {R('100 * (t - c)', 2)} AS absolute_uplift_pp, {R('z', 3)} AS z_statistic, {_BY_Z} AS significance_verdict
FROM test
"""
)

X5 = (
    _BOTH
    + f"""
SELECT kc AS control_conversions, nc AS control_n, kt AS treatment_conversions, nt AS treatment_n, {R('z', 6)} AS z_statistic FROM test
"""
)

_STEPS = 4000


def _simpson(density: str, upper: str) -> str:
    """1 - 2 * the integral of ``density`` (in x) from 0 to ``upper``."""
    weight = f"CASE WHEN i IN (0, {_STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"1 - 2 * sum({weight} * {density.replace('x', f'(i * {upper} / {_STEPS}.0)')}) * any_value({upper}) / {3 * _STEPS}.0"


_P = (
    _BOTH
    + f""",
tail AS (
    SELECT any_value(kc) AS kc, any_value(nc) AS nc, any_value(kt) AS kt, any_value(nt) AS nt, any_value(z) AS z,
           {_simpson('(exp(-x * x / 2) / sqrt(2 * pi()))'.replace('exp', 'EXP'), 'abs(z)').replace('EXP', 'exp')} AS p
    FROM test, range({_STEPS + 1}) r(i)
)"""
)

X5P = (
    _P
    + f"""
SELECT kc AS control_conversions, nc AS control_n, kt AS treatment_conversions, nt AS treatment_n,
       {R('z', 7)} AS z_statistic, {R('p', 7)} AS p_value, {_BY_P} AS verdict
FROM tail
"""
)

X13 = _P + f"\nSELECT nc AS control_n, nt AS treatment_n, {_BY_P} AS verdict FROM tail"

X12 = (
    _BOTH
    + f"""
SELECT {R('100 * c', 2)} AS control_conversion_pct, {R('100 * t', 2)} AS treatment_conversion_pct,
       {R('100 * (t - c)', 2)} AS absolute_uplift_pp, {R('z', 2)} AS z_statistic,
       CASE WHEN t <= c OR t IS NULL OR c IS NULL THEN 'DO NOT ROLL OUT: no significant positive uplift observed'
            WHEN abs(z) >= 1.96 THEN 'RECOMMEND ROLLOUT: uplift is positive and statistically significant at 95% CI'
            ELSE 'DIRECTIONALLY POSITIVE: extend test duration to confirm significance' END AS recommendation
FROM test
"""
)

#: Value of each unit: the revenue sum as it is, or the number of bookings.
_UNITS = """
unit AS (
    SELECT experiment_group AS g,
           coalesce((SELECT sum(revenue) FROM app_events e WHERE e.user_id = x.user_id AND event_name = 'booking_completed'), 0)::DOUBLE AS revenue,
           (SELECT count(*) FROM app_events e WHERE e.user_id = x.user_id AND event_name = 'booking_completed')::DOUBLE AS bookings
    FROM app_experiments x
)"""

X3 = (
    _UNITS
    + f""",
per AS (SELECT g, count(*) AS n, {R('sum(revenue)', 2)} AS total, {R('avg(revenue)', 2)} AS arpu FROM unit GROUP BY g)
SELECT g AS experiment_group, n, total AS total_revenue_eur, arpu AS arpu_eur,
       {R("100 * (arpu - max(arpu) FILTER (g = 'control') OVER ()) / nullif(max(arpu) FILTER (g = 'control') OVER (), 0)", 1)} AS arpu_uplift_vs_control_pct
FROM per
"""
)


def _sides(value: str, variance: str) -> str:
    return (
        _UNITS
        + f""",
sides AS (
    SELECT {', '.join(f"(count(*) FILTER (g = '{g}'))::DOUBLE AS n{s}, avg({value}) FILTER (g = '{g}') AS m{s}, {variance}({value}) FILTER (g = '{g}') AS v{s}" for g, s in (('control', 'c'), ('treatment', 't')))}
    FROM unit
)"""
    )


X6 = (
    _sides("revenue", "var_pop")
    + f""",
scored AS (SELECT *, (mt - mc) / nullif(sqrt(vc / nc + vt / nt), 0) AS z FROM sides)
SELECT {R('mc', 2)} AS control_arpu_eur, {R('mt', 2)} AS treatment_arpu_eur, {R('mt - mc', 2)} AS absolute_uplift_eur,
       {R('z', 3)} AS z_statistic, {_BY_Z} AS significance_verdict
FROM scored
"""
)


def _welch(value: str) -> str:
    return (
        _sides(value, "var_samp")
        + """,
welch AS (
    SELECT mc, mt, (mt - mc) / nullif(sqrt(vc / nc + vt / nt), 0) AS t,
           pow(vc / nc + vt / nt, 2) / nullif(pow(vc / nc, 2) / nullif(nc - 1, 0) + pow(vt / nt, 2) / nullif(nt - 1, 0), 0) AS df
    FROM sides
)"""
    )


def _welch_columns(k: int) -> str:
    return f"""{R('mc', k)} AS control_mean, {R('mt', k)} AS treatment_mean, {R('100 * (mt - mc) / nullif(mc, 0)', k)} AS relative_uplift_pct,
       {R('t', k)} AS t_statistic, {R('df', k)} AS welch_df"""


def X7(value: str = "revenue") -> str:
    return _welch(value) + f"\nSELECT {_welch_columns(4)} FROM welch"


def X7P(value: str = "revenue") -> str:
    density = "(exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * pow(1 + @ * @ / df, -(df + 1) / 2))"
    integral = _simpson(density.replace("exp", "EXP").replace("@", "x"), "abs(t)").replace("EXP", "exp")
    return (
        _welch(value)
        + f""",
tail AS (SELECT any_value(mc) AS mc, any_value(mt) AS mt, any_value(t) AS t, any_value(df) AS df, {integral} AS p FROM welch, range({_STEPS + 1}) r(i))
SELECT {_welch_columns(7)}, {R('p', 7)} AS p_value, {_BY_P} AS verdict FROM tail
"""
    )


X8 = f"""
share AS (SELECT experiment_group, count(*) AS n, count_if(converted)::BIGINT AS k, avg(converted::INT::DOUBLE) AS p FROM app_experiments GROUP BY ALL)
SELECT experiment_group, n, k AS conversions, {R('100 * p', 4)} AS rate,
       {R('100 * (p - 1.96 * sqrt(p * (1 - p) / n))', 4)} AS ci_low, {R('100 * (p + 1.96 * sqrt(p * (1 - p) / n))', 4)} AS ci_high
FROM share
"""


def X9(value: str = "revenue") -> str:
    half = f"1.96 * stddev_samp({value}) / sqrt(count(*))"
    return (
        _UNITS
        + f"""
SELECT g AS experiment_group, count(*) AS n, {R(f'avg({value})', 4)} AS mean,
       {R(f'avg({value}) - {half}', 4)} AS ci_low, {R(f'avg({value}) + {half}', 4)} AS ci_high
FROM unit GROUP BY g
"""
    )


X10 = f"""
SELECT experiment_group, COUNT(*) AS converted_users,
       {R('avg(days_to_conversion)', 1)} AS avg_days_to_conversion,
       {R('quantile_cont(days_to_conversion, 0.5)', 1)} AS median_days_to_conversion
FROM app_experiments WHERE converted GROUP BY ALL
"""

X11 = f"""
SELECT {WEEK('exposure_date')} AS exposure_week, experiment_group, COUNT(*) AS users_exposed, count_if(converted)::BIGINT AS conversions,
       {R(PCT('count_if(converted)', 'COUNT(*)'), 1)} AS conversion_rate_pct
FROM app_experiments GROUP BY ALL
"""
