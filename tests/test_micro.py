"""Hand-made micro tables with hand-computed answers (one per trap / rule)."""

import pytest
from pyspark.sql import functions as F

from conftest import D, TS, events_df, users_df


@pytest.fixture(scope="module")
def micro(spark):
    users = users_df(
        spark,
        [
            ("U1", D(2024, 1, 1), "Germany", "iOS", "Organic", "25-34", "control", "iOS"),
            ("U2", D(2024, 1, 1), "Spain", "Android", "Referral", None, "treatment", "Web"),
            ("U3", D(2024, 1, 2), "France", "Web", "Organic", "18-24", "control", "Web"),
            ("U4", D(2024, 1, 5), "Mars", "iOS", "Direct", "55+", "treatment", "iOS"),
        ],
    )
    events = events_df(
        spark,
        [
            ("E1", "U1", TS(2024, 1, 1, 10, 0), "S1", "app_open", None),
            ("E2", "U1", TS(2024, 1, 1, 10, 5), "S1", "search_started", None),
            ("E3", "U1", TS(2024, 1, 1, 10, 10), "S1", "search_completed", None),
            ("E4", "U1", TS(2024, 1, 1, 10, 20), "S1", "booking_started", None),
            ("E5", "U1", TS(2024, 1, 1, 10, 30), "S1", "booking_completed", 10.0),
            ("E6", "U1", TS(2024, 1, 2, 9, 0), "S2", "app_open", None),
            ("E7", "U1", TS(2024, 1, 8, 9, 0), "S3", "search_started", None),
            ("E8", "U1", TS(2024, 1, 8, 9, 0), "S3", "ride_option_viewed", None),
            ("E9", "U2", TS(2024, 1, 1, 12, 0), "S4", "booking_completed", 5.0),
            ("E10", "U2", TS(2024, 1, 3, 12, 0), "S5", "booking_cancelled", 2.0),
            ("E11", "U4", TS(2024, 1, 4, 8, 0), "S6", "app_open", None),
            ("E12", "U9", TS(2024, 1, 4, 8, 0), "S7", "app_open", None),
            ("E1", "U4", TS(2024, 1, 6, 8, 0), "S8", "booking_completed", None),
            ("E14", "U4", TS(2024, 1, 6, 8, 5), "S8", "payment_failed", -1.0),
        ],
    )
    from cohortlab.sources.experiments import derive_experiments

    return users, events, derive_experiments(users, events)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_duplicate_orphan_and_before_signup(micro):
    from cohortlab.operators import quality as dq

    users, events, exp = micro
    t = {"users": users, "events": events, "experiments": exp}
    assert rows(dq.duplicate_keys(t)) == [("events.event_id", "E1", 2)]
    assert rows(dq.orphans(users, {"events": events, "experiments": exp})) == [("events", "U9", 1)]
    assert rows(dq.events_before_signup(users, events)) == [("E11", "U4", D(2024, 1, 4), D(2024, 1, 5))]


def test_revenue_rules(micro):
    from cohortlab.operators import quality as dq

    _, events, _ = micro
    assert dict(rows(dq.revenue_integrity(events))) == {
        "negative_revenue": 1,
        "revenue_on_non_completed_booking": 1,
        "completed_booking_missing_revenue": 1,
    }
    assert dq.cancelled_revenue(events).first()[0] == 1


def test_session_prerequisites_are_set_membership(micro):
    from cohortlab.operators import quality as dq

    _, events, _ = micro
    assert dict(rows(dq.session_prerequisites(events))) == {
        "booking_completed_without_booking_started": 2,
        "booking_started_without_search_started": 0,
    }


def test_domain_violations_unknown_country(micro):
    from cohortlab.operators import quality as dq

    users, events, exp = micro
    got = rows(dq.domain_violations({"users": users, "events": events, "experiments": exp}))
    assert got == [("users.country", "Mars", 1)]


def test_retention_counts_never_active_users(micro):
    from cohortlab.operators import retention as ret

    users, events, _ = micro
    r = ret.retention(users, events, days=(1, 7)).first().asDict()
    assert r == {
        "total_users": 4,
        "day1_retained_users": 2,
        "day1_retention_pct": 50.0,
        "day7_retained_users": 1,
        "day7_retention_pct": 25.0,
    }


def test_churn_twins(micro):
    from cohortlab.operators import kpi, retention as ret

    users, events, _ = micro
    # all-user denominator, never-active not churned
    assert ret.churn(users, events, inactive=2).first().asDict() == {
        "total_users": 4,
        "churned_users": 2,
        "churn_rate_pct": 50.0,
    }
    # active-user denominator (orphan U9 is active in events)
    assert kpi.exec_kpis_churn(users, events, inactive=2).first()["churn_rate_pct"] == 75.0


def test_funnel_independent_reach(micro):
    from cohortlab.operators import funnel

    users, events, _ = micro
    got = {r["stage"]: (r["users_reached"], r["pct_of_top_of_funnel"], r["pct_of_previous_stage"], r["drop_off_pct_vs_previous"]) for r in funnel.compute_funnel(users, events).collect()}
    assert got == {
        "signup": (4, 100.0, None, None),
        "search_started": (1, 25.0, 25.0, 75.0),
        "booking_started": (1, 25.0, 100.0, 0.0),
        "booking_completed": (3, 75.0, 300.0, -200.0),
    }


def test_abandonment_of_sessions_without_goal(micro):
    from cohortlab.operators import funnel

    _, events, _ = micro
    assert rows(funnel.abandonment(events)) == [("search_started", 1, 100.0)]  # of two at the last time, the later name


def test_revenue_kpis_with_missing_revenue(micro):
    from cohortlab.operators import kpi

    users, events, _ = micro
    assert kpi.revenue_kpis(users, events).first().asDict() == {
        "total_revenue_eur": 15.0,
        "arpu_eur": 3.75,
        "arppu_eur": 5.0,
        "avg_booking_value_eur": 7.5,
        "bookings_per_user_overall": 0.75,
        "bookings_per_paying_user": 1.0,
    }


def test_age_group_unspecified(micro):
    from cohortlab.operators import kpi

    users, _, _ = micro
    got = rows(kpi.composition(users, "age_group", null_label="Unspecified"))
    assert got == [("18-24", 1, 25.0), ("25-34", 1, 25.0), ("55+", 1, 25.0), ("Unspecified", 1, 25.0)]


def test_empty_events(micro, spark):
    from cohortlab.operators import funnel, kpi

    users, events, _ = micro
    empty = events.limit(0)
    counts = dict(rows(funnel.funnel_counts(users, empty)))
    assert counts == {"signup": 4, "search_started": 0, "booking_started": 0, "booking_completed": 0}
    assert kpi.activation(users, empty).first().asDict() == {"total_users": 4, "activated_users": 0, "activation_rate_pct": 0.0}


def test_week_keys(spark):
    from cohortlab.functions.expr import week_key

    df = spark.createDataFrame([(D(2023, 1, 1),), (D(2024, 1, 1),), (D(2024, 12, 30),), (D(2025, 1, 5),), (D(2025, 1, 6),)], "d date")
    got = [r[0] for r in df.select(week_key("d")).collect()]
    assert got == ["2023-W00", "2024-W01", "2024-W53", "2025-W00", "2025-W01"]


def test_rounding_half_away_from_zero(spark):
    from cohortlab.functions.expr import rnd

    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (-0.001,), (None,)], "x double")
    got = [r for r in df.select(rnd("x", 0).alias("a"), rnd(F.col("x"), 2).alias("b")).collect()]
    assert [(r.a, r.b) for r in got] == [(3.0, 2.5), (-3.0, -2.5), (0.0, 0.13), (0.0, 0.0), (None, None)]
    assert str(got[3].b) == "0.0"  # no negative zero


def test_zero_conversion_arms(spark):
    from cohortlab.operators import experiment as xp

    exp = spark.createDataFrame(
        [("A", "control", False, None), ("B", "control", False, None), ("C", "treatment", False, None), ("D", "treatment", False, None)],
        "user_id string, experiment_group string, converted boolean, days_to_conversion int",
    )
    r = xp.prop_ztest(exp).first()
    assert r["z_statistic"] is None and r["significance_verdict"] == "Not statistically significant"
    assert xp.rollout_decision(exp).first()["recommendation"].startswith("DO NOT ROLL OUT")


def test_median_even_and_odd(spark):
    from cohortlab.operators import experiment as xp

    exp = spark.createDataFrame(
        [("A", "control", True, 1), ("B", "control", True, 3), ("C", "control", True, 10), ("D", "treatment", True, 2), ("E", "treatment", True, 4), ("F", "treatment", False, None)],
        "user_id string, experiment_group string, converted boolean, days_to_conversion int",
    )
    got = {r["experiment_group"]: (r["converted_users"], r["avg_days_to_conversion"], r["median_days_to_conversion"]) for r in xp.time_to_conversion(exp).collect()}
    assert got == {"control": (3, 4.7, 3.0), "treatment": (2, 3.0, 3.0)}


def test_derived_experiments(micro):
    _, _, exp = micro
    got = {r["user_id"]: (r["converted"], r["conversion_date"], r["days_to_conversion"]) for r in exp.collect()}
    assert got == {
        "U1": (True, D(2024, 1, 1), 0),
        "U2": (True, D(2024, 1, 1), 0),
        "U3": (False, None, None),
        "U4": (True, D(2024, 1, 6), 1),
    }


def test_distribution_tails():
    from cohortlab.functions.stats import normal_two_tailed_p, student_t_two_tailed_p

    assert normal_two_tailed_p(1.959963984540054) == pytest.approx(0.05, abs=1e-9)
    assert normal_two_tailed_p(0.0) == pytest.approx(1.0)
    assert student_t_two_tailed_p(2.228138851986, 10) == pytest.approx(0.05, abs=1e-7)
    assert student_t_two_tailed_p(12.706204736, 1) == pytest.approx(0.05, abs=1e-7)
    assert student_t_two_tailed_p(1.959963984540054, 1e7) == pytest.approx(0.05, abs=1e-5)


def test_csv_ingest_round_trip(spark, tmp_path):
    from cohortlab.sources.io import ingest_csv, load_tables

    src = tmp_path / "csv"
    src.mkdir()
    (src / "users.csv").write_text(
        "user_id,signup_date,country,city,platform,acquisition_channel,age_group,experiment_group,first_device_type\n"
        "U1,2024-01-01,Germany,Berlin,iOS,Organic,,control,iOS\n"
    )
    (src / "events.csv").write_text(
        "event_id,user_id,event_time,event_date,session_id,event_name,product_area,device_type,revenue,ride_distance_km,payment_method\n"
        "E1,U1,2024-01-01 10:00:00,2024-01-01,U1_S001,booking_completed,Booking,iOS,12.5,3.2,None\n"
    )
    (src / "experiments.csv").write_text(
        "user_id,experiment_name,experiment_group,exposure_date,converted,conversion_date,days_to_conversion\n"
        "U1,simplified_booking_flow,control,2024-01-01,True,2024-01-01,3.0\n"
        "U2,simplified_booking_flow,treatment,2024-01-01,False,,\n"
    )
    counts = ingest_csv(spark, str(src), str(tmp_path / "pq"), none_is_null=False)
    assert counts == {"users": 1, "events": 1, "experiments": 2}
    t = load_tables(spark, str(tmp_path / "pq"))
    ev = t.events.first()
    assert ev["payment_method"] == "None" and ev["revenue"] == 12.5  # literal kept on request
    assert t.users.first()["age_group"] is None
    ex = {r["user_id"]: (r["converted"], r["days_to_conversion"]) for r in t.experiments.collect()}
    assert ex == {"U1": (True, 3), "U2": (False, None)}  # pandas-style "3.0" integer column
    parity = load_tables(spark, str(src), fmt="csv")  # default: pandas missing tokens → NULL
    assert parity.events.first()["payment_method"] is None
    assert parity.users.first()["age_group"] is None


def test_active_users_approx_close_to_exact(micro):
    from cohortlab.operators.kpi import active_users

    _, events, _ = micro
    for grain in ("day", "week_mon", "month"):
        exact = sorted(tuple(r) for r in active_users(events, grain).collect())
        approx = sorted(tuple(r) for r in active_users(events, grain, approx=True).select(*active_users(events, grain).columns).collect())
        assert exact == approx  # tiny cardinalities are exact in HLL++


def test_validation_report(micro):
    from cohortlab.operators import quality as dq

    users, events, exp = micro
    rows_ = dq.validation_report(users, events, exp).collect()
    rep = {(r["table_name"], r["check_name"]): (r["violations"], r["severity"]) for r in rows_}
    bad = {k: v for k, v in rep.items() if v[0] != 0}
    warned = {k for k in bad if k[1].startswith("null_rate_")}
    assert {k: v for k, v in bad.items() if k not in warned} == {
        ("users", "domain_country"): (1, "fail"),
        ("users", "signup_span_below_300_days"): (1, "warn"),
        ("events", "negative_revenue"): (1, "fail"),
        ("events", "revenue_on_non_completed_booking"): (1, "fail"),
        ("events", "completed_booking_missing_revenue"): (1, "fail"),
        ("events", "cancelled_or_failed_with_revenue"): (1, "fail"),
        ("events", "duplicate_event_id"): (1, "fail"),
        ("events", "orphan_user_id"): (1, "fail"),
        ("events", "event_before_signup"): (1, "fail"),
        ("events", "sessions_booking_completed_without_booking_started"): (2, "fail"),
        ("all", "overall"): (9, "fail"),
    }
    # one warning for each column with too many nulls
    assert sorted(t for t, _ in warned) == ["events", "events", "users"] and all(bad[k][1] == "warn" for k in warned)
    assert all(sev == "ok" for (v, sev) in rep.values() if v == 0)
    said = {(r["table_name"], r["check_name"]): r["message"] for r in rows_}
    assert said["all", "overall"].startswith("FAILED: 9 failed, 4 warnings, ")
    assert said["events", "negative_revenue"] == "events: 1 rows violate negative_revenue"


def test_validation_report_reports_a_missing_column(micro):
    from cohortlab.operators import quality as dq

    users, events, exp = micro
    rows_ = dq.validation_report(users.drop("signup_date"), events.drop("payment_method", "session_id"), exp).collect()
    rep = {(r["table_name"], r["check_name"]): (r["violations"], r["severity"], r["message"]) for r in rows_}
    assert rep["events", "required_columns"] == (2, "fail", "events: session_id is missing, payment_method is missing")
    assert rep["users", "required_columns"][:2] == (1, "fail") and rep["experiments", "required_columns"][:2] == (0, "ok")
    assert ("events", "domain_payment_method") not in rep and ("events", "negative_revenue") in rep


def test_revenue_is_summed_unrounded(spark):
    from cohortlab.operators import kpi
    from conftest import events_df, users_df

    users = users_df(spark, [("U1", D(2024, 1, 1), "Germany", "iOS", "Organic", None, "control", "iOS")])
    events = events_df(spark, [(f"E{i}", "U1", TS(2024, 1, 2, i), "S", "booking_completed", 10.004) for i in range(3)])
    assert kpi.headline(users, events).first()["total_revenue_eur"] == 30.01
    assert kpi.booking_trend(events).first()["revenue_eur"] == 30.01


def test_arms_of_one_user_have_no_variance(spark):
    from cohortlab.operators import experiment as xp
    from cohortlab.sources.experiments import derive_experiments
    from conftest import events_df, users_df

    users = users_df(spark, [(f"U{i}", D(2024, 1, 1), "Germany", "iOS", "Organic", None, g, "iOS") for i, g in enumerate(["control", "treatment", "treatment"])])
    events = events_df(spark, [("E1", "U1", TS(2024, 1, 2), "S", "booking_completed", 5.0)])
    exp = derive_experiments(users, events)
    row = xp.welch_ttest(exp, events).first()
    assert (row["control_mean"], row["treatment_mean"], row["t_statistic"], row["p_value"]) == (0.0, 2.5, None, None)
    ci = {r["experiment_group"]: (r["mean"], r["ci_low"]) for r in xp.mean_ci(exp, events).collect()}
    assert ci["control"] == (0.0, None) and ci["treatment"][1] < 2.5


def test_small_p_values_are_not_rounded_away(spark):
    from cohortlab.functions.stats import normal_p_udf

    assert abs(spark.range(1).select(normal_p_udf(F.lit(6.0)).alias("p")).first()["p"] - 1.973175e-09) < 1e-14


@pytest.mark.parametrize("values", [list(range(47)), [0, 10], [7.5] * 4, [0.1 * k for k in range(100)]])
def test_histogram_bins_by_edges(spark, values):
    import numpy as np

    from cohortlab.operators.segments import histogram

    got = [r["count"] for r in histogram(spark.createDataFrame([(float(v),) for v in values], "x double"), "x").orderBy("bin").collect()]
    assert got == np.histogram(values, bins=30)[0].tolist()


def test_crosstab_has_a_column_for_every_value_present(spark):
    from cohortlab.operators.kpi import crosstab

    df = spark.createDataFrame([("a", "iOS"), ("a", "TV"), ("b", None)], "ch string, p string")
    out = crosstab(df, "ch", "p", normalize=True)
    assert out.columns == ["ch", "iOS".lower() + "_pct", "tv_pct", "null_pct", "total_users"] or out.columns == ["ch", "tv_pct", "ios_pct", "null_pct", "total_users"]
    assert {r["ch"]: (r["ios_pct"], r["tv_pct"], r["null_pct"]) for r in out.collect()} == {"a": (50.0, 50.0, 0.0), "b": (0.0, 0.0, 100.0)}


def test_missing_tokens_in_any_csv_column(spark, tmp_path):
    from cohortlab.sources.io import read_csv_table

    path = tmp_path / "events.csv"
    head = "event_id,user_id,event_time,event_date,session_id,event_name,product_area,device_type,revenue,ride_distance_km,payment_method"
    path.write_text(head + "\nE1,U1,2024-01-01 10:00:00,2024-01-01,S1,booking_completed,Booking,iOS,NaN,NA,None\nE2,U1,NULL,n/a,S1,app_open,Engagement,iOS,3.5,,Card\n")
    rows_ = {r["event_id"]: r for r in read_csv_table(spark, str(path), "events").collect()}
    assert (rows_["E1"]["revenue"], rows_["E1"]["ride_distance_km"], rows_["E1"]["payment_method"]) == (None, None, None)
    assert (rows_["E2"]["event_time"], rows_["E2"]["event_date"], rows_["E2"]["revenue"]) == (None, None, 3.5)
    path.write_text(head + "\nE1,U1,2024-01-01 10:00:00,2024-01-01,S1,app_open,Engagement,iOS,12x,,\n")
    with pytest.raises(Exception):
        read_csv_table(spark, str(path), "events").collect()


def test_schema_contract(micro, spark):
    from cohortlab.operators import quality as dq

    users, events, exp = micro
    assert all(r[-1] == "ok" for r in dq.schema_contract(events, "events"))
    broken = events.drop("session_id").withColumn("revenue", F.col("revenue").cast("string"))
    got = {r[1]: r[-1] for r in dq.schema_contract(broken, "events") if r[-1] != "ok"}
    assert got == {"session_id": "missing", "revenue": "wrong_type"}


def test_session_across_midnight(spark):
    from cohortlab.operators import funnel
    from conftest import events_df

    ev = events_df(
        spark,
        [
            ("A1", "U1", TS(2024, 1, 1, 23, 50), "S9", "search_started", None),
            ("A2", "U1", TS(2024, 1, 2, 0, 10), "S9", "promo_viewed", None),
        ],
    )
    assert rows(funnel.abandonment(ev)) == [("promo_viewed", 1, 100.0)]


def test_safe_pct_zero_denominator(spark):
    from cohortlab.functions.expr import pct, safe_pct

    df = spark.createDataFrame([(1, 4), (3, 0)], "n long, d long")
    got = [(r.a, r.b) for r in df.select(safe_pct("n", "d").alias("a"), pct("n", "d").alias("b")).collect()]
    assert got == [(25.0, 25.0), (0.0, None)]


def test_write_table_is_idempotent_and_month_partitioned(micro, tmp_path):
    import os

    from cohortlab.sources.io import load_tables, write_table

    users, events, exp = micro
    out = str(tmp_path / "tables")
    for _ in range(2):  # drop-and-recreate: the second run replaces the first
        counts = {}
        for name, df in (("users", users), ("events", events), ("experiments", exp)):
            counts.update(write_table(df, os.path.join(out, name), name))
    assert counts == {"users": 4, "events": 14, "experiments": 4}
    assert sorted(p for p in os.listdir(os.path.join(out, "events")) if p.startswith("event_month=")) == ["event_month=2024-01"]
    t = load_tables(events.sparkSession, out)
    assert (t.users.count(), t.events.count(), t.experiments.count()) == (4, 14, 4)
    jan = t.events.filter("event_month = '2024-01'")
    assert jan.count() == 14
    assert "PartitionFilters: [isnotnull(event_month" in jan._jdf.queryExecution().executedPlan().toString()
