"""The report job runs every report on canonical tables and writes them."""

import os

from pyspark.sql import functions as F


def test_every_report_runs_and_writes(spark, tmp_path):
    from cohortlab.reports import REPORTS, run_reports
    from cohortlab.sources.io import ingest_csv, load_tables
    from cohortlab.sources.schema import EVENTS_SCHEMA, EXPERIMENTS_SCHEMA, USERS_SCHEMA
    from cohortlab.sources.testdata import clickstream

    # canonical tables derived from the driver's smallest test tables
    t = clickstream(spark, "/root/testdata/sf0.001")
    src = tmp_path / "csv"
    for name, df, schema in (("users", t.users, USERS_SCHEMA), ("events", t.events, EVENTS_SCHEMA), ("experiments", t.experiments, EXPERIMENTS_SCHEMA)):
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        if name == "events":
            out = out.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
        out.coalesce(1).write.option("header", True).csv(str(src / f"{name}_dir"))
        part = next(p for p in os.listdir(src / f"{name}_dir") if p.endswith(".csv"))
        os.replace(src / f"{name}_dir" / part, src / f"{name}.csv")
    ingest_csv(spark, str(src), str(tmp_path / "pq"))
    tables = load_tables(spark, str(tmp_path / "pq"))
    # every report resolves against the canonical schema ...
    for name, fn in REPORTS.items():
        assert fn(tables).schema.fields, name
    # ... and a representative subset runs end to end into Parquet / CSV
    subset = ["dq_validation_report", "kpi_executive_churn", "funnel", "cohort_matrix", "segment_value_tiers", "ab_revenue_welch"]
    done = run_reports(tables, str(tmp_path / "out"), names=subset)
    assert set(done) == set(subset)
    funnel = {r["stage"]: r["users_reached"] for r in spark.read.parquet(done["funnel"]).collect()}
    assert funnel["signup"] == t.users.count()
    csv = run_reports(tables, str(tmp_path / "csv_out"), fmt="csv", names=["kpi_dau"])
    assert spark.read.option("header", True).csv(csv["kpi_dau"]).count() == t.events.select("event_date").distinct().count()


def test_fact_table_path_equals_raw_events(spark):
    from cohortlab.reports import FACTS_READY, REPORTS, shared_facts
    from cohortlab.sources.testdata import clickstream

    t = clickstream(spark, "/root/testdata/sf0.01")
    facts = shared_facts(t)
    for name in sorted(FACTS_READY):
        raw = sorted(map(tuple, REPORTS[name](t).collect()))
        fast = sorted(map(tuple, REPORTS[name](facts).collect()))
        assert raw == fast, name


import pytest


@pytest.mark.parametrize("binding", ["E", "O"])  # clickstream (activation) and multi-year orders (months, churn)
def test_user_day_path_equals_raw_events(spark, binding):
    from cohortlab.reports import DAYS_READY, REPORTS, shared_user_days
    from cohortlab.sources.testdata import BINDINGS

    t = BINDINGS[binding](spark, "/root/testdata/sf0.01")
    days = shared_user_days(t)
    for name in sorted(DAYS_READY):
        raw = sorted(map(tuple, REPORTS[name](t).collect()))
        fast = sorted(map(tuple, REPORTS[name](days).collect()))
        assert raw == fast, name


def test_shared_tables_are_staged_and_read_events_once(spark):
    """Both fact tables come from one scan of events, are Parquet files in the
    shared checkpoint folder, and are deleted after the reports."""
    import glob

    from cohortlab.plans.scale import drop_staged
    from cohortlab.reports import shared_facts, shared_user_days
    from cohortlab.sources.testdata import clickstream

    t = clickstream(spark, "/root/testdata/sf0.001")
    root = (spark.sparkContext.getCheckpointDir() or "").replace("file:", "")
    before = set(glob.glob(root + "/staged-*"))
    days = shared_user_days(t)
    facts = shared_facts(t, days)
    assert len(set(glob.glob(root + "/staged-*")) - before) == 2
    for df in (facts.events, days.events):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" in plan and "Aggregate" not in plan
        pruned = df.select("user_id")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<user_id:bigint>" in pruned
        drop_staged(df)
    assert set(glob.glob(root + "/staged-*")) == before
