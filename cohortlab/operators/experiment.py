"""Experiment (A/B test) operators (X1–X13).

All test statistics are computed from per-arm aggregates (count, means,
variances, exact medians): one hash aggregate keyed by arm over the
experiment table, after per-user revenue has been pre-aggregated from
events.  The arms are then pivoted into one row with conditional ``max``
(fixed by the ``control`` / ``treatment`` labels), and the statistics are
column expressions on that one row.  p-values (normal / Student-t tails) are
the only Python, evaluated by an Arrow UDF on that aggregated row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import div, plain, rnd, rnd_pct, shown, week_key
from cohortlab.functions.stats import normal_p_udf, significance_label, student_t_p_udf, z_verdict
from cohortlab.plans.facts import user_bookings
from cohortlab.plans.moments import merged, sums, variance
from cohortlab.plans.scale import with_scalars
from cohortlab.plans.selection import selected_quantiles
from cohortlab.sources.schema import DEFAULT_TAXONOMY, Taxonomy

CONTROL, TREATMENT = "control", "treatment"


def _conv(experiments: DataFrame):
    return F.col("converted").cast("int")


def arms(experiments: DataFrame) -> DataFrame:
    """X1 — per group: users, converted users, conversion % (2 dp)."""
    agg = experiments.groupBy("experiment_group").agg(
        F.count(F.lit(1)).alias("users"), F.sum(_conv(experiments)).cast("long").alias("converted_users")
    )
    return agg.select("*", rnd_pct("converted_users", "users", 2).alias("conversion_rate_pct"))


def _pivot(agg: DataFrame, cols) -> DataFrame:
    """Arm rows → one row with ``<col>_c`` / ``<col>_t`` columns."""
    g = F.col("experiment_group")
    out = []
    for c in cols:
        out.append(F.max(F.when(g == CONTROL, F.col(c))).alias(f"{c}_c"))
        out.append(F.max(F.when(g == TREATMENT, F.col(c))).alias(f"{c}_t"))
    return agg.agg(*out)


def _prop_row(experiments: DataFrame) -> DataFrame:
    agg = experiments.groupBy("experiment_group").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_conv(experiments)).cast("long").alias("conv")
    )
    row = _pivot(agg, ["n", "conv"])
    p_c = div("conv_c", "n_c")
    p_t = div("conv_t", "n_t")
    pooled = div(F.col("conv_c") + F.col("conv_t"), F.col("n_c") + F.col("n_t"))
    se = F.sqrt(pooled * (F.lit(1.0) - pooled) * (div(F.lit(1.0), "n_c") + div(F.lit(1.0), "n_t")))
    return row.select("*", p_c.alias("p_c"), p_t.alias("p_t"), pooled.alias("p_pooled"), se.alias("_se"))


def uplift(experiments: DataFrame) -> DataFrame:
    """X2 — control / treatment conversion %, absolute (pp) and relative uplift."""
    r = _prop_row(experiments)
    return r.select(
        rnd(F.lit(100.0) * F.col("p_c"), 2).alias("control_conversion_pct"),
        rnd(F.lit(100.0) * F.col("p_t"), 2).alias("treatment_conversion_pct"),
        rnd(F.lit(100.0) * (F.col("p_t") - F.col("p_c")), 2).alias("absolute_uplift_pp"),
        rnd(div(F.lit(100.0) * (F.col("p_t") - F.col("p_c")), "p_c"), 1).alias("relative_uplift_pct"),
        F.col("n_c").alias("control_n"),
        F.col("n_t").alias("treatment_n"),
    )


def _z(r: DataFrame) -> DataFrame:
    return r.withColumn("_z", F.try_divide(F.col("p_t") - F.col("p_c"), F.col("_se")))


def prop_ztest(experiments: DataFrame) -> DataFrame:
    """X4 — pooled two-proportion z-test with the inclusive 2.576 / 1.96 / 1.645 verdict."""
    r = _z(_prop_row(experiments))
    return r.select(
        rnd(F.lit(100.0) * F.col("p_c"), 2).alias("control_rate_pct"),
        rnd(F.lit(100.0) * F.col("p_t"), 2).alias("treatment_rate_pct"),
        rnd(F.lit(100.0) * (F.col("p_t") - F.col("p_c")), 2).alias("absolute_uplift_pp"),
        rnd("_z", 3).alias("z_statistic"),
        z_verdict(F.col("_z")).alias("significance_verdict"),
    )


def two_proportion_ztest(experiments: DataFrame, with_p: bool = True, digits: int | None = None) -> DataFrame:
    """X5 — z statistic (treatment − control) and its two-tailed p-value,
    with the p-value significance label (X13).  Values are as computed unless
    ``digits`` asks for rounding."""
    r = _z(_prop_row(experiments))
    out = r.select(
        F.col("conv_c").alias("control_conversions"),
        F.col("n_c").alias("control_n"),
        F.col("conv_t").alias("treatment_conversions"),
        F.col("n_t").alias("treatment_n"),
        shown(F.col("_z"), digits).alias("z_statistic"),
        F.col("_z"),
    )
    if not with_p:
        return out.drop("_z")
    p = normal_p_udf(F.col("_z"))
    return out.withColumn("p_value", shown(p, digits)).withColumn("verdict", significance_label(p)).drop("_z")


def user_revenue(experiments: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY, keep=()) -> DataFrame:
    """Per experiment unit: group, lifetime revenue (exact decimal, 0 when none), bookings."""
    per = user_bookings(events, tax)
    return experiments.select("user_id", "experiment_group", *keep).join(per, "user_id", "left").select(
        "user_id",
        "experiment_group",
        *keep,
        F.coalesce("revenue", F.lit(0).cast("decimal(38,10)")).alias("revenue"),
        F.coalesce("bookings", F.lit(0)).cast("long").alias("bookings"),
    )


def arm_arpu(experiments: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """X3 — per group: n, revenue, ARPU (2 dp) and ARPU uplift vs control
    computed from the *rounded* ARPUs (1 dp)."""
    ur = user_revenue(experiments, events, tax)
    agg = ur.groupBy("experiment_group").agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("_rev")).select(
        "experiment_group",
        "n",
        rnd(plain("_rev"), 2).alias("total_revenue_eur"),
        rnd(div("_rev", "n"), 2).alias("arpu_eur"),
    )
    ctrl = agg.agg(F.max(F.when(F.col("experiment_group") == CONTROL, F.col("arpu_eur"))).alias("_ctrl"))
    return with_scalars(agg, ctrl).select(
        "experiment_group",
        "n",
        "total_revenue_eur",
        "arpu_eur",
        rnd(div(F.lit(100.0) * (F.col("arpu_eur") - F.col("_ctrl")), "_ctrl"), 1).alias("arpu_uplift_vs_control_pct"),
    )


def daily_moments(experiments: DataFrame, events: DataFrame, value: str, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """Per exposure day and arm: count, sum and sum of squares of a per-user
    value (``revenue`` or ``bookings``), exact.  Tables of this kind can be
    kept, and added up over days or over slices of users."""
    per_user = user_revenue(experiments, events, tax, keep=("exposure_date",))
    return per_user.groupBy("exposure_date", "experiment_group").agg(*sums(value))


def arm_moments(daily: DataFrame) -> DataFrame:
    """Per arm, from :func:`daily_moments`: n, mean, population and sample
    variance; the sample variance of one user is NULL."""
    total = merged(daily, ["experiment_group"])
    return total.select("experiment_group", "n", div(plain("s1"), "n").alias("mean"), variance(0).alias("var_pop"), variance(1).alias("var_samp"))


def _moments(experiments: DataFrame, events: DataFrame, value: str, tax: Taxonomy) -> DataFrame:
    """Moments per arm; ``experiments`` may be a :func:`daily_moments` table
    (of the same ``value``), which has all that is needed."""
    daily = experiments if "s2" in experiments.columns else daily_moments(experiments, events, value, tax)
    return arm_moments(daily)


def mean_ztest(experiments: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """X6 — two-sample z-test on revenue per unit with the population
    variance of each arm."""
    r = _pivot(_moments(experiments, events, "revenue", tax), ["n", "mean", "var_pop"])
    z = F.try_divide(F.col("mean_t") - F.col("mean_c"), F.sqrt(F.col("var_pop_c") / F.col("n_c") + F.col("var_pop_t") / F.col("n_t")))
    return r.select(
        rnd("mean_c", 2).alias("control_arpu_eur"),
        rnd("mean_t", 2).alias("treatment_arpu_eur"),
        rnd(F.col("mean_t") - F.col("mean_c"), 2).alias("absolute_uplift_eur"),
        rnd(z, 3).alias("z_statistic"),
        z_verdict(z).alias("significance_verdict"),
    )


def welch_ttest(experiments: DataFrame, events: DataFrame, value: str = "revenue", tax: Taxonomy = DEFAULT_TAXONOMY, with_p: bool = True, digits: int | None = None) -> DataFrame:
    """X7 — Welch's t-test (sample variances), statistic = treatment − control,
    Welch–Satterthwaite degrees of freedom, two-tailed p-value and label.
    ``value`` is ``revenue`` (per user, EUR) or ``bookings``.  An arm of one
    user has no sample variance: the statistic, degrees of freedom and p-value
    are NULL.  Values are as computed unless ``digits`` asks for rounding."""
    r = _pivot(_moments(experiments, events, value, tax), ["n", "mean", "var_samp"])
    a, b = F.try_divide("var_samp_c", "n_c"), F.try_divide("var_samp_t", "n_t")
    t = F.try_divide(F.col("mean_t") - F.col("mean_c"), F.sqrt(a + b))
    spread = F.try_divide(a * a, F.col("n_c") - 1) + F.try_divide(b * b, F.col("n_t") - 1)
    res = r.select("mean_c", "mean_t", t.alias("_t"), F.try_divide((a + b) * (a + b), spread).alias("_df"))
    res = res.select(
        shown(F.col("mean_c"), digits).alias("control_mean"),
        shown(F.col("mean_t"), digits).alias("treatment_mean"),
        shown(div(F.lit(100.0) * (F.col("mean_t") - F.col("mean_c")), "mean_c"), digits).alias("relative_uplift_pct"),
        shown(F.col("_t"), digits).alias("t_statistic"),
        shown(F.col("_df"), digits).alias("welch_df"),
        "_t",
        "_df",
    )
    if not with_p:
        return res.drop("_t", "_df")
    p = student_t_p_udf(F.col("_t"), F.col("_df"))
    return res.withColumn("p_value", shown(p, digits)).withColumn("verdict", significance_label(p)).drop("_t", "_df")


def wald_ci(experiments: DataFrame, z: float = 1.96, digits: int | None = None) -> DataFrame:
    """X8 — per group: conversion rate with an (unclipped) Wald interval, in %."""
    agg = experiments.groupBy("experiment_group").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_conv(experiments)).cast("long").alias("conversions")
    )
    p = div("conversions", "n")
    se = F.sqrt(p * (F.lit(1.0) - p) / F.col("n"))
    return agg.select(
        "experiment_group",
        "n",
        "conversions",
        shown(p * 100.0, digits).alias("rate"),
        shown((p - F.lit(z) * se) * 100.0, digits).alias("ci_low"),
        shown((p + F.lit(z) * se) * 100.0, digits).alias("ci_high"),
    )


def mean_ci(experiments: DataFrame, events: DataFrame, value: str = "revenue", z: float = 1.96, tax: Taxonomy = DEFAULT_TAXONOMY, digits: int | None = None) -> DataFrame:
    """X9 — per group: mean of ``revenue`` or ``bookings`` per user with a
    normal interval (sample std, ddof = 1); NULL bounds for one user."""
    m = _moments(experiments, events, value, tax)
    sem = F.sqrt(F.try_divide("var_samp", "n"))
    return m.select(
        "experiment_group",
        F.col("n"),
        shown(F.col("mean"), digits).alias("mean"),
        shown(F.col("mean") - F.lit(z) * sem, digits).alias("ci_low"),
        shown(F.col("mean") + F.lit(z) * sem, digits).alias("ci_high"),
    )


def time_to_conversion(experiments: DataFrame) -> DataFrame:
    """X10 — per group over converted units: count, mean and exact median of
    days_to_conversion (1 dp).

    The median is selected by histograms (:func:`selected_quantiles`): its
    state is one histogram a pass and group, whatever the values' domain."""
    conv = experiments.filter(F.col("converted"))
    stats = conv.groupBy("experiment_group").agg(
        F.count(F.lit(1)).alias("converted_users"),
        rnd(F.avg(F.col("days_to_conversion").cast("double")), 1).alias("avg_days_to_conversion"),
    )
    middle = selected_quantiles(conv, "days_to_conversion", [0.5], ["experiment_group"]).select(F.col("experiment_group").alias("_g"), "q0")
    both = stats.join(middle, F.col("experiment_group").eqNullSafe(F.col("_g")), "left")
    return both.select("experiment_group", "converted_users", "avg_days_to_conversion", rnd("q0", 1).alias("median_days_to_conversion"))


def conversion_trend(experiments: DataFrame) -> DataFrame:
    """X11 — exposure week (Monday-based) × group: exposed, conversions, %."""
    agg = experiments.groupBy(week_key("exposure_date").alias("exposure_week"), "experiment_group").agg(
        F.count(F.lit(1)).alias("users_exposed"), F.sum(_conv(experiments)).cast("long").alias("conversions")
    )
    return agg.select("*", rnd_pct("conversions", "users_exposed", 1).alias("conversion_rate_pct"))


# Rollout recommendation texts.
ROLLOUT = "RECOMMEND ROLLOUT: uplift is positive and statistically significant at 95% CI"
EXTEND = "DIRECTIONALLY POSITIVE: extend test duration to confirm significance"
HOLD = "DO NOT ROLL OUT: no significant positive uplift observed"


def rollout_decision(experiments: DataFrame, z_crit: float = 1.96) -> DataFrame:
    """X12 — conversion readout with a three-way rollout recommendation."""
    r = _z(_prop_row(experiments))
    diff = F.col("p_t") - F.col("p_c")
    rec = F.when((diff > 0) & (F.abs(F.col("_z")) >= z_crit), F.lit(ROLLOUT)).when(diff > 0, F.lit(EXTEND)).otherwise(F.lit(HOLD))
    return r.select(
        rnd(F.lit(100.0) * F.col("p_c"), 2).alias("control_conversion_pct"),
        rnd(F.lit(100.0) * F.col("p_t"), 2).alias("treatment_conversion_pct"),
        rnd(F.lit(100.0) * diff, 2).alias("absolute_uplift_pp"),
        rnd("_z", 2).alias("z_statistic"),
        rec.alias("recommendation"),
    )
