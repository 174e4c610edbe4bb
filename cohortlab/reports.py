"""Run every report on canonical ``users`` / ``events`` / ``experiments`` tables.

This is the batch job a user of the original SQL suite runs on their own data:
each entry of :data:`REPORTS` is one result table (one per SQL statement or
notebook computation), computed with the original default parameters
(retention days 1/7/30, 7-day activation, 30-day churn, …) and written as
Parquet or CSV under ``<output>/<name>``.

    spark-submit --py-files cohortlab.zip cohortlab/reports.py --input DIR --output DIR
    python -m cohortlab.reports --input DIR [--format csv] --output DIR

Input is a folder with ``users``, ``events`` and ``experiments``: Parquet
folders, ``*.csv`` files with ``--format csv``, or the versioned tables of
``sources.io.publish_tables`` with ``--format versions``.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlab.operators import adoption, all_dims, experiment as xp, funnel, kpi, quality as dq, retention as ret, segments as seg
from cohortlab.plans.facts import user_day_facts, user_facts_from_days
from cohortlab.plans.scale import drop_staged, staged
from cohortlab.plans.stores import refresh_user_days
from cohortlab.sources.schema import EVENT_NAMES, Tables
from cohortlab.sources.versions import VersionedTable


def _t(t: Tables) -> dict:
    return {"users": t.users, "events": t.events, "experiments": t.experiments}


_DIMS = {"country": None, "platform": None, "age_group": "Unspecified", "acquisition_channel": None}

REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    # data quality
    "dq_row_counts": lambda t: dq.row_counts(t.users, t.events, t.experiments),
    "dq_duplicate_keys": lambda t: dq.duplicate_keys(_t(t)),
    "dq_full_row_duplicates": lambda t: dq.full_row_duplicates(_t(t)),
    "dq_orphans": lambda t: dq.orphans(t.users, {"events": t.events, "experiments": t.experiments}),
    "dq_events_before_signup": lambda t: dq.events_before_signup(t.users, t.events),
    "dq_revenue_integrity": lambda t: dq.revenue_integrity(t.events),
    "dq_cancelled_revenue": lambda t: dq.cancelled_revenue(t.events),
    "dq_null_profile": lambda t: dq.null_profile(_t(t)),
    "dq_null_rates_users": lambda t: dq.null_rates(t.users, "users"),
    "dq_null_rates_events": lambda t: dq.null_rates(t.events, "events"),
    "dq_null_rates_experiments": lambda t: dq.null_rates(t.experiments, "experiments"),
    "dq_missing_users": lambda t: dq.missing_report(t.users, "users"),
    "dq_missing_events": lambda t: dq.missing_report(t.events, "events"),
    "dq_missing_experiments": lambda t: dq.missing_report(t.experiments, "experiments"),
    "dq_domain_violations": lambda t: dq.domain_violations(_t(t)),
    "dq_domain_violations_all": lambda t: dq.domain_violations(_t(t), dq.default_domain_checks(), nulls_are_invalid=True),
    "dq_group_mismatch": lambda t: dq.group_mismatch(t.users, t.experiments),
    "dq_signup_span": lambda t: dq.date_span(t.users, "signup_date", "signup"),
    "dq_event_span": lambda t: dq.date_span(t.events, "event_date", "event"),
    "dq_date_bounds": lambda t: dq.date_bounds(t.users, t.events),
    "dq_session_prerequisites": lambda t: dq.session_prerequisites(t.events),
    "dq_converted_consistency": lambda t: dq.converted_consistency(t.events, t.experiments),
    "dq_volume_checks": lambda t: dq.volume_checks(t.users, t.events, t.experiments),
    "dq_validation_report": lambda t: dq.validation_report(t.users, t.events, t.experiments),
    # overview and KPIs
    "kpi_headline": lambda t: kpi.headline(t.users, t.events),
    **{f"kpi_users_by_{d}": (lambda d, n: lambda t: kpi.composition(t.users, d, null_label=n))(d, n) for d, n in _DIMS.items()},
    **{f"kpi_users_by_{d}": (lambda d: lambda t: kpi.composition(t.users, d))(d) for d in ("city", "experiment_group", "first_device_type")},
    "kpi_signup_trend": lambda t: kpi.signup_trend(t.users),
    "kpi_booking_trend": lambda t: kpi.booking_trend(t.events),
    "kpi_events_by_product_area": lambda t: kpi.composition(t.events, "product_area", count_name="event_count", pct_name="pct_of_events"),
    "kpi_ever_active": lambda t: kpi.ever_active(t.users, t.events),
    "kpi_dau": lambda t: kpi.active_users(t.events, "day"),
    "kpi_wau": lambda t: kpi.active_users(t.events, "week_mon"),
    "kpi_mau": lambda t: kpi.active_users(t.events, "month"),
    "kpi_stickiness": lambda t: kpi.stickiness(t.events),
    "kpi_activation": lambda t: kpi.activation(t.users, t.events),
    "kpi_conversion": lambda t: kpi.conversion(t.users, t.events),
    "kpi_revenue": lambda t: kpi.revenue_kpis(t.users, t.events),
    **{f"kpi_revenue_by_{d}": (lambda d: lambda t: kpi.revenue_by(t.users, t.events, d))(d) for d in ("country", "platform", "acquisition_channel")},
    "kpi_executive": lambda t: kpi.exec_kpis(t.users, t.events),
    "kpi_executive_churn": lambda t: kpi.exec_kpis_churn(t.users, t.events),
    "kpi_tiles": lambda t: kpi.kpi_tiles(t.users, t.events),
    "kpi_conversion_by_channel": lambda t: kpi.conversion_by(t.users, t.events, "acquisition_channel"),
    "kpi_conversion_by_platform": lambda t: kpi.conversion_by(t.users, t.events, "platform"),
    "kpi_platform_device_mismatch": lambda t: kpi.mismatch_rate(t.users),
    "kpi_country_platform": lambda t: kpi.crosstab(t.users, "country", "platform", ["iOS", "Android", "Web"]),
    "kpi_channel_platform_mix": lambda t: kpi.crosstab(t.users, "acquisition_channel", "platform", ["iOS", "Android", "Web"], normalize=True),
    # funnel
    "funnel_counts": lambda t: funnel.funnel_counts(t.users, t.events),
    "funnel": lambda t: funnel.compute_funnel(t.users, t.events),
    "funnel_by_platform": lambda t: funnel.funnel_by(t.users, t.events, "platform"),
    "funnel_by_channel": lambda t: funnel.funnel_by(t.users, t.events, "acquisition_channel"),
    "funnel_attempt_outcomes": lambda t: funnel.attempt_outcomes(t.events),
    "funnel_abandonment": lambda t: funnel.abandonment(t.events),
    "funnel_channel_steps": lambda t: funnel.step_rates(t.users, t.events),
    # retention, churn, cohorts
    "retention_flags": lambda t: ret.compute_retention_flags(t.users, t.events),
    "retention": lambda t: ret.retention(t.users, t.events),
    **{f"retention_by_{d}": (lambda d: lambda t: ret.retention_by(t.users, t.events, d))(d) for d in ("country", "platform", "acquisition_channel")},
    "retention_curve": lambda t: ret.retention_curve(t.users, t.events),
    "churn": lambda t: ret.churn(t.users, t.events),
    "cohort_sizes": lambda t: ret.cohort_sizes(t.users),
    "cohort_retention": lambda t: ret.cohort_retention(t.users, t.events),
    "cohort_matrix": lambda t: ret.cohort_matrix(t.users, t.events),
    "cohort_revenue": lambda t: ret.cohort_revenue(t.users, t.events),
    "cohort_revenue_cumulative": lambda t: ret.cohort_revenue_cumulative(t.users, t.events),
    # the families above for every dimension, one pass each
    "kpi_users_by_all_dims": lambda t: all_dims.composition_by_all(t.users, _DIMS | dict.fromkeys(("city", "experiment_group", "first_device_type"))),
    "kpi_revenue_by_all_dims": lambda t: all_dims.revenue_by_all(t.users, t.events, _DIMS),
    "retention_by_all_dims": lambda t: all_dims.retention_by_all(t.users, t.events, _DIMS),
    "segment_by_all_dims": lambda t: all_dims.segment_summary_all(t.users, t.events, _DIMS),
    # feature adoption
    "adoption": lambda t: adoption.adoption(t.users, t.events),
    "adoption_effect": lambda t: adoption.adoption_effect(t.users, t.events),
    "adoption_by_platform": lambda t: adoption.adoption_by(t.users, t.events, "platform"),
    "adoption_depth": lambda t: adoption.adoption_depth(t.users, t.events),
    "adoption_impact": lambda t: adoption.adoption_impact(t.users, t.events),
    # segmentation and statistics
    **{f"segment_by_{d}": (lambda d, n: lambda t: seg.segment_summary(t.users, t.events, d, n))(d, n) for d, n in _DIMS.items()},
    "segment_value_tiers": lambda t: seg.value_tiers(t.users, t.events),
    "segment_top": lambda t: seg.top_segments(t.users, t.events),
    "segment_underperforming_channels": lambda t: seg.underperformers(t.users, t.events),
    "segment_retention_risk": lambda t: seg.retention_risk(t.users, t.events),
    "user_features": lambda t: seg.user_features(t.users, t.events, t.experiments),
    "user_feature_correlations": lambda t: seg.corr_matrix(seg.user_features(t.users, t.events, t.experiments)),
    "describe_events": lambda t: seg.describe(t.events, ["revenue", "ride_distance_km"]),
    "describe_experiments": lambda t: seg.describe(t.experiments, ["days_to_conversion"]),
    "histogram_revenue": lambda t: seg.histogram(t.events, "revenue"),
    "histogram_distance": lambda t: seg.histogram(t.events, "ride_distance_km"),
    "histogram_days_to_conversion": lambda t: seg.histogram(t.experiments, "days_to_conversion"),
    # experiments
    "ab_arms": lambda t: xp.arms(t.experiments),
    "ab_uplift": lambda t: xp.uplift(t.experiments),
    "ab_arpu": lambda t: xp.arm_arpu(t.experiments, t.events),
    "ab_conversion_ztest": lambda t: xp.prop_ztest(t.experiments),
    "ab_conversion_pvalue": lambda t: xp.two_proportion_ztest(t.experiments),
    "ab_revenue_ztest": lambda t: xp.mean_ztest(t.experiments, t.events),
    "ab_revenue_welch": lambda t: xp.welch_ttest(t.experiments, t.events, "revenue"),
    "ab_bookings_welch": lambda t: xp.welch_ttest(t.experiments, t.events, "bookings"),
    "ab_conversion_ci": lambda t: xp.wald_ci(t.experiments),
    "ab_arpu_ci": lambda t: xp.mean_ci(t.experiments, t.events, "revenue"),
    "ab_bookings_ci": lambda t: xp.mean_ci(t.experiments, t.events, "bookings"),
    "ab_time_to_conversion": lambda t: xp.time_to_conversion(t.experiments),
    "ab_weekly_trend": lambda t: xp.conversion_trend(t.experiments),
    "ab_rollout_decision": lambda t: xp.rollout_decision(t.experiments),
}


# Reports whose operators read events only through per-user aggregates
# (event flags, booking totals): they can run from the shared fact table.
FACTS_READY = {
    "kpi_ever_active", "kpi_conversion", "kpi_revenue",
    "kpi_revenue_by_country", "kpi_revenue_by_platform", "kpi_revenue_by_acquisition_channel",
    "kpi_conversion_by_channel", "kpi_conversion_by_platform",
    "funnel_counts", "funnel", "funnel_by_platform", "funnel_by_channel", "funnel_channel_steps",
    "adoption", "adoption_by_platform", "adoption_impact",
    "kpi_revenue_by_all_dims", "segment_by_all_dims",
    "segment_by_country", "segment_by_platform", "segment_by_age_group", "segment_by_acquisition_channel",
    "segment_value_tiers", "segment_top", "segment_underperforming_channels",
    "ab_arpu", "ab_revenue_ztest", "ab_revenue_welch", "ab_bookings_welch", "ab_arpu_ci", "ab_bookings_ci",
}


# Reports that read events only at (user, day) grain: they can run from the
# shared per-(user, day) fact table.
DAYS_READY = {
    "kpi_dau", "kpi_wau", "kpi_mau", "kpi_stickiness",
    "retention_flags", "retention", "retention_by_country", "retention_by_platform",
    "retention_by_acquisition_channel", "retention_by_all_dims", "retention_curve", "churn",
    "cohort_retention", "cohort_matrix", "segment_retention_risk",
    "kpi_activation", "kpi_executive", "kpi_executive_churn", "kpi_tiles",
    "adoption_effect", "adoption_depth",
}


# Reports with a row per user or event: written as they come, the others in
# the order of their columns.
ROW_LISTS = {"retention_flags", "user_features", "dq_events_before_signup", "dq_orphans", "dq_duplicate_keys", "dq_group_mismatch"}


def shared_user_days(tables: Tables) -> Tables:
    """Tables whose ``events`` slot is the per-(user, day) fact table with a
    flag for every tracked event name, staged once as Parquet: one events scan
    for every report in :data:`DAYS_READY`, and each report reads only the
    columns it needs."""
    days = staged(user_day_facts(tables.events, names=EVENT_NAMES))
    return Tables(tables.users, days, tables.experiments)


def shared_facts(tables: Tables, days: Tables | None = None) -> Tables:
    """Tables whose ``events`` slot is the per-user fact table, staged once for
    every report in :data:`FACTS_READY`.  It is rolled up from the (user, day)
    table, so events are scanned once for both."""
    own = days or shared_user_days(tables)
    facts = staged(user_facts_from_days(own.events))
    if days is None:
        drop_staged(own.events)
    return Tables(tables.users, facts, tables.experiments)


def stored_user_days(spark: SparkSession, data_dir: str) -> DataFrame:
    """The kept (user, day) facts of the versioned events below ``data_dir``
    (``publish_tables``, ``stores.add_events``), brought up to date first:
    only months whose events changed since are built again."""
    events, facts = (VersionedTable(spark, os.path.join(data_dir, n)) for n in ("events", "user_days"))
    refresh_user_days(events, facts)
    return facts.read()


def run_reports(tables: Tables, output: str, fmt: str = "parquet", names=None, use_facts: bool = True, user_days: DataFrame | None = None) -> dict:
    """Compute each report and write it to ``<output>/<name>`` (Parquet or CSV).

    Every report is written straight from its distributed plan (no collect);
    with ``use_facts`` the per-user reports read the shared per-user fact
    table and the day-grained ones the shared user-day table, instead of
    scanning events again; both are deleted at the end.  With ``user_days``
    (:func:`stored_user_days`) the kept facts are read instead of building
    them, and stay.  Returns {name: output path}."""
    from cohortlab.sources.io import write_csv

    names = list(names or REPORTS)
    shared = use_facts and (FACTS_READY | DAYS_READY).intersection(names)
    kept = Tables(tables.users, user_days, tables.experiments) if user_days is not None else None
    days = kept or shared_user_days(tables) if shared else None
    facts = shared_facts(tables, days) if shared and FACTS_READY.intersection(names) else None
    done = {}
    for name in names:
        source = tables
        if facts is not None and name in FACTS_READY:
            source = facts
        elif days is not None and name in DAYS_READY:
            source = days
        df = REPORTS[name](source)
        if name not in ROW_LISTS:
            df = df.orderBy(*df.columns)
        path = os.path.join(output, name)
        if fmt == "csv":
            write_csv(df, path)
        else:
            df.write.mode("overwrite").parquet(path)
        done[name] = path
    for table in filter(None, (facts, days)):
        if table is not kept:
            drop_staged(table.events)
    return done


def main(argv=None) -> None:
    from cohortlab.session import checkpoint_dir
    from cohortlab.sources.io import load_published, load_tables

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--format", choices=("parquet", "csv", "versions"), default="parquet", help="input format; with versions the (user, day) facts are kept beside the tables")
    ap.add_argument("--output-format", choices=("parquet", "csv"), default="parquet")
    ap.add_argument("--only", nargs="*", help="report names to run (default: all)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cohortlab-reports").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    days = None
    if args.format == "versions":
        tables, days = load_published(spark, args.input), stored_user_days(spark, args.input)
    else:
        tables = load_tables(spark, args.input, fmt=args.format)
    for name, path in run_reports(tables, args.output, args.output_format, args.only, user_days=days).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
