"""Registered queries: name → (testdata binding, operator call, oracle SQL).

Binding ``E`` is the clickstream view (events + customers), binding ``O`` the
order-history view (orders as bookings); see FIXTURES.md.  Parameters that
differ from the operator defaults follow FIXTURES.md (the clickstream spans
30 days, so its retention checkpoints are 1/7/14 and churn inactivity 2 days).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from cohortlab.operators import funnel
from sql_oracle import funnel as sf


@dataclass(frozen=True)
class Query:
    binding: str
    fn: Callable
    sql: str | None


REGISTRY: dict[str, Query] = {}


def reg(name: str, binding: str, fn: Callable, sql: str | None) -> None:
    assert name not in REGISTRY, name
    REGISTRY[name] = Query(binding, fn, sql)


# --- funnel (U1–U6) ---------------------------------------------------------
reg("u1_funnel_counts", "E", lambda t: funnel.funnel_counts(t.users, t.events), sf.U1)
reg("u2_funnel", "E", lambda t: funnel.compute_funnel(t.users, t.events), sf.U2)
reg("u2_funnel_subset", "E", lambda t: funnel.compute_funnel(t.users, t.events, subset=t.users.filter("platform = 'iOS'")), sf.U2_IOS)
reg("u3_funnel_by_platform", "E", lambda t: funnel.funnel_by(t.users, t.events, "platform"), sf.U3("platform"))
reg("u3_funnel_by_channel", "E", lambda t: funnel.funnel_by(t.users, t.events, "acquisition_channel"), sf.U3("acquisition_channel"))
reg("u4_attempt_outcomes", "E", lambda t: funnel.attempt_outcomes(t.events), sf.U4)
reg("u5_abandonment", "E", lambda t: funnel.abandonment(t.events), sf.U5)
reg("u6_channel_funnel", "E", lambda t: funnel.step_rates(t.users, t.events), sf.U6())

# --- overview and KPIs (K1–K22) ----------------------------------------------
from cohortlab.operators import kpi  # noqa: E402
from sql_oracle import kpi as sk  # noqa: E402

reg("k1_headline", "E", lambda t: kpi.headline(t.users, t.events), sk.K1)
reg("k1_headline_orders", "O", lambda t: kpi.headline(t.users, t.events), sk.K1)
reg("k2_users_by_country", "E", lambda t: kpi.composition(t.users, "country"), sk.K2("country"))
reg("k2_users_by_platform", "E", lambda t: kpi.composition(t.users, "platform"), sk.K2("platform"))
reg("k2_users_by_channel", "E", lambda t: kpi.composition(t.users, "acquisition_channel"), sk.K2("acquisition_channel"))
reg("k2_users_by_age_group", "E", lambda t: kpi.composition(t.users, "age_group", null_label="Unspecified"), sk.K2("age_group", "Unspecified"))
reg("k3_users_by_city", "E", lambda t: kpi.composition(t.users, "city"), sk.K2("city"))
reg("k3_users_by_experiment_group", "E", lambda t: kpi.composition(t.users, "experiment_group"), sk.K2("experiment_group"))
reg("k3_users_by_first_device", "E", lambda t: kpi.composition(t.users, "first_device_type"), sk.K2("first_device_type"))
reg("k4_signup_trend", "O", lambda t: kpi.signup_trend(t.users), sk.K4)
reg("k5_booking_trend", "O", lambda t: kpi.booking_trend(t.events), sk.K5)
reg("k5_booking_trend_clicks", "E", lambda t: kpi.booking_trend(t.events), sk.K5)
reg(
    "k6_events_by_product_area",
    "E",
    lambda t: kpi.composition(t.events, "product_area", count_name="event_count", pct_name="pct_of_events"),
    sk.K2("product_area", table="app_events", count_name="event_count", pct_name="pct_of_events"),
)
reg("k7_ever_active", "E", lambda t: kpi.ever_active(t.users, t.events), sk.K7)
reg("k8_dau", "E", lambda t: kpi.active_users(t.events, "day"), sk.K8)
reg("k9_wau", "E", lambda t: kpi.active_users(t.events, "week_mon"), sk.K9)
reg("k9_wau_orders", "O", lambda t: kpi.active_users(t.events, "week_mon"), sk.K9)
reg("k10_mau", "O", lambda t: kpi.active_users(t.events, "month"), sk.K10)
reg("k11_stickiness", "E", lambda t: kpi.stickiness(t.events), sk.K11)
reg("k11_stickiness_orders", "O", lambda t: kpi.stickiness(t.events), sk.K11)
reg("k12_activation", "E", lambda t: kpi.activation(t.users, t.events), sk.K12)
reg("k13_conversion", "E", lambda t: kpi.conversion(t.users, t.events), sk.K13)
reg("k14_revenue_kpis", "E", lambda t: kpi.revenue_kpis(t.users, t.events), sk.K14)
reg("k14_revenue_kpis_orders", "O", lambda t: kpi.revenue_kpis(t.users, t.events), sk.K14)
reg("k15_revenue_by_country", "E", lambda t: kpi.revenue_by(t.users, t.events, "country"), sk.K15("country"))
reg("k15_revenue_by_platform", "E", lambda t: kpi.revenue_by(t.users, t.events, "platform"), sk.K15("platform"))
reg("k15_revenue_by_channel", "E", lambda t: kpi.revenue_by(t.users, t.events, "acquisition_channel"), sk.K15("acquisition_channel"))
reg("k16_exec_kpis", "E", lambda t: kpi.exec_kpis(t.users, t.events), sk.K16)
reg("k17_exec_kpis_churn", "E", lambda t: kpi.exec_kpis_churn(t.users, t.events, inactive=2), sk.K17(2))
reg("k17_exec_kpis_churn_orders", "O", lambda t: kpi.exec_kpis_churn(t.users, t.events, inactive=30), sk.K17(30))
reg("k18_kpi_tiles", "E", lambda t: kpi.kpi_tiles(t.users, t.events, day=14), sk.K18(14))
reg("k18_kpi_tiles_orders", "O", lambda t: kpi.kpi_tiles(t.users, t.events, day=30), sk.K18(30))
reg("k19_conversion_by_channel", "E", lambda t: kpi.conversion_by(t.users, t.events, "acquisition_channel"), sk.K19("acquisition_channel"))
reg("k19_conversion_by_platform", "E", lambda t: kpi.conversion_by(t.users, t.events, "platform"), sk.K19("platform"))
reg("k20_platform_device_mismatch", "E", lambda t: kpi.mismatch_rate(t.users), sk.K20)
reg("k21_country_platform_crosstab", "E", lambda t: kpi.crosstab(t.users, "country", "platform", ["iOS", "Android", "Web"]), sk.K21)
reg(
    "k22_channel_platform_mix",
    "E",
    lambda t: kpi.crosstab(t.users, "acquisition_channel", "platform", normalize=True),
    sk.K22,
)

# --- retention, churn, cohorts (T0–T4, C1–C4) --------------------------------
from cohortlab.operators import retention as ret  # noqa: E402
from sql_oracle import retention as sr  # noqa: E402

_E_DAYS = (1, 7, 14)
reg("t0_retention_flags", "E", lambda t: ret.compute_retention_flags(t.users, t.events, _E_DAYS), sr.T0(_E_DAYS))
reg("t1_retention", "E", lambda t: ret.retention(t.users, t.events, _E_DAYS), sr.T1(_E_DAYS))
reg("t1_retention_orders", "O", lambda t: ret.retention(t.users, t.events), sr.T1())
for _dim, _tag in (("country", "country"), ("platform", "platform"), ("acquisition_channel", "channel")):
    reg(f"t2_retention_by_{_tag}", "E", (lambda d: lambda t: ret.retention_by(t.users, t.events, d, _E_DAYS))(_dim), sr.T2(_dim, _E_DAYS))
reg("t3_retention_curve", "E", lambda t: ret.retention_curve(t.users, t.events, max_day=29), sr.T3(29))
reg("t3_retention_curve_orders", "O", lambda t: ret.retention_curve(t.users, t.events, max_day=60), sr.T3(60))
reg("t4_churn", "O", lambda t: ret.churn(t.users, t.events, inactive=30), sr.T4(30))
reg("t4_churn_clicks", "E", lambda t: ret.churn(t.users, t.events, inactive=2), sr.T4(2))
reg("c1_cohort_sizes", "O", lambda t: ret.cohort_sizes(t.users), sr.C1)
reg("c2_cohort_retention", "O", lambda t: ret.cohort_retention(t.users, t.events), sr.C2)
reg("c3_cohort_matrix", "O", lambda t: ret.cohort_matrix(t.users, t.events), sr.C3())
reg("c4_cohort_revenue", "O", lambda t: ret.cohort_revenue(t.users, t.events), sr.C4)

# --- feature adoption (A1–A5) -------------------------------------------------
from cohortlab.operators import adoption  # noqa: E402
from sql_oracle import adoption as sa  # noqa: E402

reg("a1_adoption", "E", lambda t: adoption.adoption(t.users, t.events), sa.A1)
reg("a2_adoption_effect", "E", lambda t: adoption.adoption_effect(t.users, t.events, days=(7, 14)), sa.A2((7, 14)))
reg("a3_adoption_by_platform", "E", lambda t: adoption.adoption_by(t.users, t.events, "platform"), sa.A3("platform"))
reg("a4_adoption_depth", "E", lambda t: adoption.adoption_depth(t.users, t.events, day=14), sa.A4(14))
reg("a5_adoption_impact", "E", lambda t: adoption.adoption_impact(t.users, t.events), sa.A5)

# --- segmentation and descriptive statistics (S1–S9) ------------------------
from cohortlab.operators import segments as seg  # noqa: E402
from sql_oracle import segments as ss  # noqa: E402

for _dim, _tag, _null in (("country", "country", None), ("platform", "platform", None), ("age_group", "age_group", "Unspecified"), ("acquisition_channel", "channel", None)):
    reg(f"s1_segment_by_{_tag}", "E", (lambda d, n: lambda t: seg.segment_summary(t.users, t.events, d, n))(_dim, _null), ss.S1(_dim, _null))
reg("s2_value_tiers", "O", lambda t: seg.value_tiers(t.users, t.events), ss.S2)
reg("s2_value_tiers_clicks", "E", lambda t: seg.value_tiers(t.users, t.events), ss.S2)
reg("s3_top_segments", "E", lambda t: seg.top_segments(t.users, t.events), ss.S3())
reg("s3_top_segments_orders", "O", lambda t: seg.top_segments(t.users, t.events, ("city", "acquisition_channel")), ss.S3(("city", "acquisition_channel")))
reg("s4_underperforming_channels", "E", lambda t: seg.underperformers(t.users, t.events), ss.S4())
reg("s5_retention_risk", "E", lambda t: seg.retention_risk(t.users, t.events, day=14), ss.S5(day=14))
reg("s5_retention_risk_orders", "O", lambda t: seg.retention_risk(t.users, t.events, day=30), ss.S5(day=30))
reg("s6_user_features", "E", lambda t: seg.user_features(t.users, t.events, t.experiments, digits=4), ss.S6)
reg("s7_corr_matrix", "E", lambda t: seg.corr_matrix(seg.user_features(t.users, t.events, t.experiments), digits=4), ss.S7())
reg("s8_describe_events", "E", lambda t: seg.describe(t.events, ["revenue", "ride_distance_km"]), ss.S8("app_events", ["revenue", "ride_distance_km"]))
reg("s8_describe_experiments", "O", lambda t: seg.describe(t.experiments, ["days_to_conversion"]), ss.S8("app_experiments", ["days_to_conversion"]))
reg("s9_histogram_revenue", "E", lambda t: seg.histogram(t.events, "revenue"), ss.S9("app_events", "revenue"))
reg("s9_histogram_distance", "E", lambda t: seg.histogram(t.events, "ride_distance_km"), ss.S9("app_events", "ride_distance_km"))
reg("s9_histogram_days_to_conversion", "O", lambda t: seg.histogram(t.experiments, "days_to_conversion"), ss.S9("app_experiments", "days_to_conversion"))

# --- experiments (X1–X13) -----------------------------------------------------
from cohortlab.operators import experiment as xp  # noqa: E402
from sql_oracle import experiment as sx  # noqa: E402

for _b, _sfx in (("E", ""), ("O", "_orders")):
    reg(f"x1_arms{_sfx}", _b, lambda t: xp.arms(t.experiments), sx.X1)
    reg(f"x2_uplift{_sfx}", _b, lambda t: xp.uplift(t.experiments), sx.X2)
    reg(f"x3_arm_arpu{_sfx}", _b, lambda t: xp.arm_arpu(t.experiments, t.events), sx.X3)
    reg(f"x4_prop_ztest{_sfx}", _b, lambda t: xp.prop_ztest(t.experiments), sx.X4)
    reg(f"x6_mean_ztest{_sfx}", _b, lambda t: xp.mean_ztest(t.experiments, t.events), sx.X6)
    reg(f"x10_time_to_conversion{_sfx}", _b, lambda t: xp.time_to_conversion(t.experiments), sx.X10)
    reg(f"x11_conversion_trend{_sfx}", _b, lambda t: xp.conversion_trend(t.experiments), sx.X11)
    reg(f"x12_rollout_decision{_sfx}", _b, lambda t: xp.rollout_decision(t.experiments), sx.X12)
reg("x5_ztest_statistic", "O", lambda t: xp.two_proportion_ztest(t.experiments, with_p=False, digits=6), sx.X5)
reg("x5_ztest_pvalue", "O", lambda t: xp.two_proportion_ztest(t.experiments, digits=7), sx.X5P)
for _b, _sfx in (("E", ""), ("O", "_orders")):
    reg(f"x13_significance_label{_sfx}", _b, lambda t: xp.two_proportion_ztest(t.experiments).select("control_n", "treatment_n", "verdict"), sx.X13)
reg("x7_welch_revenue", "E", lambda t: xp.welch_ttest(t.experiments, t.events, "revenue", with_p=False, digits=4), sx.X7("revenue"))
reg("x7_welch_bookings", "E", lambda t: xp.welch_ttest(t.experiments, t.events, "bookings", with_p=False, digits=4), sx.X7("bookings"))
reg("x7_welch_revenue_pvalue", "E", lambda t: xp.welch_ttest(t.experiments, t.events, "revenue", digits=7), sx.X7P("revenue"))
reg("x8_wald_ci", "O", lambda t: xp.wald_ci(t.experiments, digits=4), sx.X8)
reg("x9_mean_ci_revenue", "E", lambda t: xp.mean_ci(t.experiments, t.events, "revenue", digits=4), sx.X9("revenue"))
reg("x9_mean_ci_bookings", "E", lambda t: xp.mean_ci(t.experiments, t.events, "bookings", digits=4), sx.X9("bookings"))

# --- data quality (DQ1–DQ19) --------------------------------------------------
from cohortlab.operators import quality as dq  # noqa: E402
from sql_oracle import quality as sq  # noqa: E402


def _tables(t):
    return {"users": t.users, "events": t.events, "experiments": t.experiments}


for _b, _sfx in (("E", ""), ("O", "_orders")):
    reg(f"dq1_row_counts{_sfx}", _b, lambda t: dq.row_counts(t.users, t.events, t.experiments), sq.DQ1)
    reg(f"dq2_duplicate_keys{_sfx}", _b, lambda t: dq.duplicate_keys(_tables(t)), sq.DQ2)
    reg(f"dq4_orphans{_sfx}", _b, lambda t: dq.orphans(t.users, {"events": t.events, "experiments": t.experiments}), sq.DQ4)
    reg(f"dq5_events_before_signup{_sfx}", _b, lambda t: dq.events_before_signup(t.users, t.events), sq.DQ5)
    reg(f"dq6_revenue_integrity{_sfx}", _b, lambda t: dq.revenue_integrity(t.events), sq.DQ6)
    reg(f"dq11_domain_violations{_sfx}", _b, lambda t: dq.domain_violations(_tables(t)), sq.DQ11())
    reg(f"dq15_session_prerequisites{_sfx}", _b, lambda t: dq.session_prerequisites(t.events), sq.DQ15)
    reg(f"dq16_converted_consistency{_sfx}", _b, lambda t: dq.converted_consistency(t.events, t.experiments), sq.DQ16)
    reg(f"dq19_validation_report{_sfx}", _b, lambda t: dq.validation_report(t.users, t.events, t.experiments), sq.DQ19())
for _b, _sfx in (("E", ""), ("O", "_orders")):
    reg(f"dq17_schema_report{_sfx}", _b, lambda t: dq.schema_report(_tables(t)), sq.DQ17())
    reg(f"io5_experiments{_sfx}", _b, lambda t: t.experiments, "SELECT * FROM app_experiments")
reg("dq3_full_row_duplicates", "E", lambda t: dq.full_row_duplicates(_tables(t)), sq.DQ3)
reg("dq7_cancelled_revenue", "E", lambda t: dq.cancelled_revenue(t.events), sq.DQ7)
reg("dq8_null_profile", "E", lambda t: dq.null_profile(_tables(t)), sq.DQ8)
for _t in ("users", "events", "experiments"):
    reg(f"dq9_null_rates_{_t}", "E", (lambda n: lambda t: dq.null_rates(_tables(t)[n], n))(_t), sq.DQ9(_t))
    reg(f"dq10_missing_report_{_t}", "E", (lambda n: lambda t: dq.missing_report(_tables(t)[n], n))(_t), sq.DQ10(_t))
reg("dq11_domain_violations_all", "E", lambda t: dq.domain_violations(_tables(t), dq.default_domain_checks(), nulls_are_invalid=True), sq.DQ11(True))
reg("dq12_group_mismatch", "E", lambda t: dq.group_mismatch(t.users, t.experiments), sq.DQ12)
reg("dq13_signup_span", "O", lambda t: dq.date_span(t.users, "signup_date", "signup"), sq.DQ13("users", "signup_date", "signup"))
reg("dq13_event_span", "O", lambda t: dq.date_span(t.events, "event_date", "event"), sq.DQ13("events", "event_date", "event"))
reg("dq14_date_bounds", "E", lambda t: dq.date_bounds(t.users, t.events), sq.DQ14())
reg("dq18_volume_checks", "E", lambda t: dq.volume_checks(t.users, t.events, t.experiments), sq.DQ18)

# --- same operators fed from the shared fact tables of the report job --------
from cohortlab.plans.facts import user_facts  # noqa: E402


def _days(t):
    return t.events.select("user_id", "event_date").distinct()


reg("u2_funnel_from_user_facts", "E", lambda t: funnel.compute_funnel(t.users, user_facts(t.events)), sf.U2)
reg("k15_revenue_by_channel_from_user_facts", "E", lambda t: kpi.revenue_by(t.users, user_facts(t.events), "acquisition_channel"), sk.K15("acquisition_channel"))
reg("s2_value_tiers_from_user_facts", "O", lambda t: seg.value_tiers(t.users, user_facts(t.events)), ss.S2)
reg("x6_mean_ztest_from_user_facts", "O", lambda t: xp.mean_ztest(t.experiments, user_facts(t.events)), sx.X6)
reg("t1_retention_from_user_days", "O", lambda t: ret.retention(t.users, _days(t)), sr.T1())
reg("c2_cohort_retention_from_user_days", "O", lambda t: ret.cohort_retention(t.users, _days(t)), sr.C2)

from cohortlab.plans.facts import user_day_facts  # noqa: E402
from cohortlab.sources.schema import EVENT_NAMES  # noqa: E402

reg("k16_exec_kpis_from_user_day_facts", "E", lambda t: kpi.exec_kpis(t.users, user_day_facts(t.events, names=EVENT_NAMES)), sk.K16)
reg("a2_adoption_effect_from_user_day_facts", "E", lambda t: adoption.adoption_effect(t.users, user_day_facts(t.events, names=EVENT_NAMES), days=(7, 14)), sa.A2((7, 14)))

# --- activity bitmaps: the same reports from one row per user ------------------
from cohortlab.plans.activity import activity_bitmap  # noqa: E402

reg("t0_retention_flags_from_bitmap", "E", lambda t: ret.compute_retention_flags(t.users, activity_bitmap(t.events), _E_DAYS), sr.T0(_E_DAYS))
reg("t1_retention_from_bitmap", "O", lambda t: ret.retention(t.users, activity_bitmap(t.events)), sr.T1())
reg("t2_retention_by_platform_from_bitmap", "E", lambda t: ret.retention_by(t.users, activity_bitmap(t.events), "platform", _E_DAYS), sr.T2("platform", _E_DAYS))
reg("t3_retention_curve_from_bitmap", "O", lambda t: ret.retention_curve(t.users, activity_bitmap(t.events), max_day=60), sr.T3(60))
reg("c2_cohort_retention_from_bitmap", "O", lambda t: ret.cohort_retention(t.users, activity_bitmap(t.events)), sr.C2)

# --- every dimension of a family in one pass ----------------------------------
from cohortlab.operators import all_dims as ad  # noqa: E402
from sql_oracle.bindings import ALL_DIMS  # noqa: E402

_DIMS = ad.SEGMENT_DIMS
_WIDE = _DIMS | {"city": None, "experiment_group": None, "first_device_type": None}
reg("k2_users_by_all_dims", "E", lambda t: ad.composition_by_all(t.users, _WIDE), ALL_DIMS(sk.K2, _WIDE))
_PLAIN = {d: None for d in _DIMS}
for _b, _sfx in (("E", ""), ("O", "_orders")):
    reg(f"k15_revenue_by_all_dims{_sfx}", _b, lambda t: ad.revenue_by_all(t.users, t.events, _PLAIN), ALL_DIMS(lambda d, _: sk.K15(d), _PLAIN))
    reg(f"s1_segment_by_all_dims{_sfx}", _b, lambda t: ad.segment_summary_all(t.users, t.events), ALL_DIMS(ss.S1, _DIMS))
reg("t2_retention_by_all_dims", "E", lambda t: ad.retention_by_all(t.users, t.events, _PLAIN, _E_DAYS), ALL_DIMS(lambda d, _: sr.T2(d, _E_DAYS), _PLAIN))
reg("t2_retention_by_all_dims_from_bitmap", "O", lambda t: ad.retention_by_all(t.users, activity_bitmap(t.events), _PLAIN), ALL_DIMS(lambda d, _: sr.T2(d), _PLAIN))

reg("c4_cohort_revenue_cumulative", "O", lambda t: ret.cohort_revenue_cumulative(t.users, t.events), sr.C4_CUMULATIVE)

# --- tables kept by month: loaded in slices, facts and sketches refreshed -----
from cohortlab.plans import stores  # noqa: E402
from cohortlab.sources import io as table_io  # noqa: E402
from cohortlab.sources.versions import VersionedTable  # noqa: E402


def _folder(df):
    import uuid

    from cohortlab.session import checkpoint_dir

    return f"{checkpoint_dir(df.sparkSession)}/store-{uuid.uuid4().hex}"


def _loaded_days(t):
    """(user, day) facts after events have arrived in three slices, one of
    them twice; facts are refreshed after each."""
    folder = _folder(t.events)
    events, facts = (VersionedTable(t.events.sparkSession, f"{folder}/{n}") for n in ("events", "user_days"))
    for part in (0, 1, 1, 2):
        stores.add_events(events, t.events.filter(f"event_id % 3 = {part}"))
        stores.refresh_user_days(events, facts)
    return facts


def _sketch_check(t, dim):
    facts = _loaded_days(t)
    sketches = VersionedTable(t.events.sparkSession, f"{facts.path}_sketches")
    stores.refresh_sketches(facts, sketches, t.users, dim)
    return stores.compare_actives(sketches.read(), facts.read(), t.users, dim).drop("estimate")


for _b, _sfx in (("E", ""), ("O", "_orders")):
    reg(f"k8_k10_actives_from_sketches{_sfx}", _b, lambda t: _sketch_check(t, "platform"), sk.ACTIVES("platform"))
reg("k17_exec_kpis_churn_from_slices", "O", lambda t: kpi.exec_kpis_churn(t.users, _loaded_days(t).read(), inactive=30), sk.K17(30))
reg("c3_cohort_matrix_from_slices", "O", lambda t: ret.cohort_matrix(t.users, _loaded_days(t).read()), sr.C3())


def _csv_round_trip(t, name):
    path = f"{_folder(t.events)}/{name}.csv"
    df = getattr(t, name)
    table_io.write_csv(df, path)
    return table_io.read_csv_table(df.sparkSession, path, name)


def _published_twice(t):
    """Events published, one month's rows replaced by none and then restored."""
    from pyspark.sql import functions as F

    table = VersionedTable(t.events.sparkSession, _folder(t.events))
    month = F.date_format("event_date", "yyyy-MM")
    table.publish(t.events, month)
    first = min(table.manifest()["parts"])
    table.publish(t.events.filter(F.lit(False)), month, keep_others=True, drop=[first])
    table.publish(t.events.filter(month == first), month, keep_others=True)
    return table.read()


#: Cells that the checked load must reject: column -> (rows by event_id, text, reason).
BROKEN_CELLS = {"revenue": (97, "12,5 EUR", "not a number"), "event_date": (101, "2024-13-45", "not a date"), "ride_distance_km": (103, "far", "not a number"), "event_time": (107, "yesterday", "not a timestamp")}


def _checked_load(t):
    """A CSV of all events with some broken cells, loaded: rows good, rejected
    and in all, and rejected cells by column and reason."""
    from pyspark.sql import functions as F

    df, path = t.events, f"{_folder(t.events)}/events.csv"
    cells = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c == "event_time" else F.col(c).cast("string") for c in df.columns}
    for c, (every, said, _) in BROKEN_CELLS.items():
        cells[c] = F.when(F.col("event_id") % every == 0, F.lit(said)).otherwise(cells[c])
    text = df.select(*[cell.alias(c) for c, cell in cells.items()])
    table_io.write_csv(text, path)
    read = table_io.read_csv_checked(df.sparkSession, path, "events")
    cells = read.rejects.groupBy(F.col("column_name").alias("what"), "reason").agg(F.count(F.lit(1)).alias("n"))
    bad = read.rejects.select("raw").distinct().agg(F.count(F.lit(1)).alias("n"))
    good = read.good.agg(F.count(F.lit(1)).alias("n"))
    rows = [(good, "good rows"), (bad, "rejected rows"), (df.agg(F.count(F.lit(1)).alias("n")), "all rows")]
    out = cells
    for frame, what in rows:
        out = out.unionByName(frame.select(F.lit(what).alias("what"), F.lit(None).cast("string").alias("reason"), "n"))
    return out


reg("io1_csv_round_trip_users", "E", lambda t: _csv_round_trip(t, "users"), "SELECT * REPLACE (user_id::VARCHAR AS user_id) FROM app_users")
reg("io1_csv_round_trip_experiments", "O", lambda t: _csv_round_trip(t, "experiments"), "SELECT * REPLACE (user_id::VARCHAR AS user_id) FROM app_experiments")
reg("io1_checked_csv_load", "E", _checked_load, sq.CHECKED_LOAD(BROKEN_CELLS))
reg("io1_checked_csv_load_orders", "O", _checked_load, sq.CHECKED_LOAD(BROKEN_CELLS))
for _b, _sfx in (("E", ""), ("O", "_orders")):
    reg(f"io2_versioned_round_trip{_sfx}", _b, _published_twice, "SELECT * FROM app_events")


# --- moments of slices, added up ------------------------------------------------
def _daily_in_slices(t, value):
    """Daily moments of three slices of the users, one below the other."""
    from functools import reduce

    slices = [xp.daily_moments(t.experiments.filter(f"user_id % 3 = {i}"), t.events, value) for i in range(3)]
    return reduce(lambda a, b: a.unionByName(b), slices)


reg("x6_mean_ztest_from_slices", "O", lambda t: xp.mean_ztest(_daily_in_slices(t, "revenue"), None), sx.X6)
reg("x7_welch_revenue_from_slices", "E", lambda t: xp.welch_ttest(_daily_in_slices(t, "revenue"), None, "revenue", with_p=False, digits=4), sx.X7("revenue"))
reg("x9_mean_ci_bookings_from_slices", "E", lambda t: xp.mean_ci(_daily_in_slices(t, "bookings"), None, "bookings", digits=4), sx.X9("bookings"))
