"""Versioned tables, facts and sketches kept by month, checked CSV loads."""

import datetime as dt
import random

import pytest
from conftest import D, TS, events_df
from pyspark.sql import functions as F

from cohortlab.plans import stores as S
from cohortlab.sources.versions import VersionedTable, refresh

ROWS = "k long, m string, x double"


def rows_of(table, *parts):
    return sorted(map(repr, table.read(parts or None).collect()))


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


# --- versions ------------------------------------------------------------------
def test_a_write_that_fails_midway_leaves_the_old_rows(spark, table):
    old = spark.createDataFrame([(i, "a" if i % 2 else "b", 1.0) for i in range(50)], ROWS)
    table.publish(old, F.col("m"))
    before, manifest = rows_of(table), table.manifest()
    broken = old.repartition(6).withColumn("x", F.when(F.col("k") == 37, F.raise_error("lost").cast("double")).otherwise(F.lit(2.0)))
    with pytest.raises(Exception, match="lost"):
        table.publish(broken, F.col("m"))
    assert rows_of(table) == before and table.manifest() == manifest
    assert table.vacuum() == 0  # the failed version left nothing behind


def test_rows_that_do_not_read_back_are_not_published(spark, table, monkeypatch):
    table.publish(spark.createDataFrame([(1, "a", 1.0)], ROWS))
    monkeypatch.setattr(VersionedTable, "_read_back", lambda self, v, s: {"all": {"folder": v, "rows": 1, "sum": "0"}})
    with pytest.raises(RuntimeError, match="nothing was published"):
        table.publish(spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0)], ROWS))
    monkeypatch.undo()
    assert table.read().count() == 1


def test_parts_are_replaced_one_by_one(spark, table):
    df = spark.createDataFrame([(1, "2024-01", 1.0), (2, "2024-02", 2.0), (3, None, 3.0), (4, "a/b ü", 4.0)], ROWS)
    assert len(table.publish(df, F.col("m"))) == 4
    assert rows_of(table) == sorted(map(repr, df.collect()))
    kept = table.read()
    new = spark.createDataFrame([(9, "2024-02", 9.0)], ROWS)
    assert table.publish(new, F.col("m"), keep_others=True) == ["2024-02"]
    assert rows_of(table, "2024-02") == sorted(map(repr, new.collect())) and table.read().count() == 4
    assert kept.count() == 4 and {r.k for r in kept.collect()} == {1, 2, 3, 4}  # a frame that was read stays
    assert table.publish(new.limit(0), F.col("m"), keep_others=True, drop=["2024-01"]) == ["2024-01"]
    assert {r.k for r in table.read().collect()} == {9, 3, 4}
    table.publish(new.limit(0), F.col("m"))
    assert table.read().count() == 0 and table.read().schema == new.schema
    assert table.vacuum() > 0 and table.read().count() == 0


def test_the_same_rows_change_nothing(spark, table):
    df = spark.createDataFrame([(i, str(i % 3), float(i)) for i in range(30)], ROWS)
    table.publish(df, F.col("m"))
    before = table.manifest()
    assert table.publish(df.repartition(7).orderBy("x"), F.col("m")) == [] and table.manifest() == before
    assert table.publish(df.withColumn("x", F.col("x") + F.when(F.col("k") == 4, 1.0).otherwise(0.0)), F.col("m")) == ["1"]


def test_two_writers_and_torn_manifests(spark, table, monkeypatch, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0)], ROWS)
    table.publish(df)
    with monkeypatch.context() as m:  # the other writer committed after this one looked
        m.setattr(VersionedTable, "_numbers", lambda self: [])
        with pytest.raises(Exception, match="(?i)already exists"):
            table._commit(df.schema.json(), {})
    (tmp_path / "t" / "manifest" / f"{2:012d}.json").write_text('{"number": 2, "par')
    assert table.read().count() == 1
    table.publish(df.union(df))
    assert table.manifest()["number"] == 3 and table.read().count() == 2


def test_nothing_published(table):
    with pytest.raises(FileNotFoundError):
        table.read()


def test_refresh_builds_changed_parts_only(spark, tmp_path):
    source, target = (VersionedTable(spark, str(tmp_path / n)) for n in "st")
    df = spark.createDataFrame([(i, "ab"[i % 2], 1.0) for i in range(10)], ROWS)
    source.publish(df, F.col("m"))
    build = lambda rows: rows.groupBy("m").agg(F.sum("x").alias("total"))
    assert refresh(source, target, build, F.col("m")) == ["a", "b"]
    assert refresh(source, target, lambda rows: 1 / 0, F.col("m")) == []  # nothing changed: nothing is built
    source.publish(spark.createDataFrame([(0, "a", 5.0), (1, "c", 2.0)], ROWS), F.col("m"), keep_others=True, drop=["b"])
    assert refresh(source, target, build, F.col("m")) == ["a", "c"]
    assert {(r.m, r.total) for r in target.read().collect()} == {("a", 5.0), ("c", 2.0)}


# --- facts by month --------------------------------------------------------------
def canonical(spark, binding="O", sf="sf0.001"):
    from cohortlab.sources.testdata import BINDINGS

    return BINDINGS[binding](spark, f"/root/testdata/{sf}")


def test_three_slices_equal_one_load_for_every_day_report(spark, tmp_path):
    from cohortlab.reports import DAYS_READY, REPORTS, shared_user_days, stored_user_days
    from cohortlab.sources.schema import Tables

    t = canonical(spark)
    events = VersionedTable(spark, str(tmp_path / "events"))
    for part in range(3):
        S.add_events(events, t.events.filter(f"event_id % 3 = {part}"))
        days = stored_user_days(spark, str(tmp_path))
    again = VersionedTable(spark, str(tmp_path / "user_days"))
    before = events.manifest(), again.manifest()
    assert S.add_events(events, t.events.filter("event_id % 3 = 1")) == [] and S.refresh_user_days(events, again) == []
    assert (events.manifest(), again.manifest()) == before  # a slice that is loaded twice changes nothing
    kept, full = Tables(t.users, days, t.experiments), shared_user_days(t)
    for name in sorted(DAYS_READY):
        assert sorted(map(repr, REPORTS[name](kept).collect())) == sorted(map(repr, REPORTS[name](full).collect())), name


def test_a_late_event_touches_its_month_only(spark, tmp_path):
    events, facts = (VersionedTable(spark, str(tmp_path / n)) for n in ("events", "user_days"))
    day = lambda i, m, u="U1": (f"E{i}", u, TS(2024, m, 5), "S", "booking_completed", 2.5)
    S.add_events(events, events_df(spark, [day(1, 1), day(2, 2), day(3, 3)]))
    assert S.refresh_user_days(events, facts) == ["2024-01", "2024-02", "2024-03"]
    assert S.add_events(events, events_df(spark, [day(4, 2), day(2, 2)])) == ["2024-02"]
    assert S.refresh_user_days(events, facts) == ["2024-02"]
    got = {r.event_date.month: (r.events, float(r.revenue)) for r in facts.read().collect()}
    assert got == {1: (1, 2.5), 2: (2, 5.0), 3: (1, 2.5)}


# --- sketches ---------------------------------------------------------------------
def test_sketches_are_within_their_bound_and_read_no_event(spark, tmp_path):
    rnd = random.Random(5)
    first = dt.date(2024, 1, 1)
    rows = [(f"U{rnd.randrange(30000)}", first + dt.timedelta(days=rnd.randrange(75))) for _ in range(90000)]
    days = spark.createDataFrame(rows, "user_id string, event_date date")
    users = spark.createDataFrame([(f"U{i}", "iOS" if i % 3 else None) for i in range(29000)], "user_id string, platform string")
    facts, sketches = (VersionedTable(spark, str(tmp_path / n)) for n in ("days", "sketches"))
    facts.publish(days, S.event_month())
    assert S.refresh_sketches(facts, sketches, users, "platform") == ["2024-01", "2024-02", "2024-03"]
    both = S.compare_actives(sketches.read(), days, users, "platform").collect()
    assert both and all(r.within_bound for r in both)
    assert max(r.actives for r in both) > 5000 and any(r.estimate != r.actives for r in both)  # estimates, not copies
    mau = S.sketched_actives(sketches.read(), grains=("month",))
    assert {f.split("/")[-5] for f in mau.inputFiles()} == {"sketches"}
    exact = {r.period: r.actives for r in S.exact_actives(days, users, grains=("month",)).collect()}
    assert all(abs(r.estimate - exact[r.period]) <= S.ERROR_BOUND * exact[r.period] for r in mau.collect())


# --- checked CSV ----------------------------------------------------------------
CSV = """event_id,user_id,event_time,event_date,session_id,event_name,product_area,device_type,revenue,ride_distance_km,payment_method
E1,U1,2024-01-05 10:00:00,2024-01-05,S1,app_open,Engagement,iOS,,,None
E2,U1,yesterday,2024-01-05,S1,app_open,Engagement,iOS,1.5,2,Card
E3,U1,2024-01-05 10:00:00,2024-13-05,S1,app_open,Engagement,iOS,1.5 EUR,NaN,Card
E4,U1,2024-01-05 10:00:00,2024-01-05,S1,app_open,Engagement,iOS,7,8,Card,extra
E5,U1,2024-01-05 10:00:00
"""


def test_bad_cells_are_set_aside(spark, tmp_path):
    from cohortlab.sources.io import read_csv_checked

    path = tmp_path / "events.csv"
    path.write_text(CSV)
    read = read_csv_checked(spark, str(path), "events")
    good = read.good.collect()
    assert [(r.event_id, r.revenue, r.payment_method) for r in good] == [("E1", None, None)] and good[0].event_date == D(2024, 1, 5)
    got = {(r.raw.split(",")[0], r.column_name, r.value, r.reason) for r in read.rejects.collect()}
    assert got == {
        ("E2", "event_time", "yesterday", "not a timestamp"), ("E3", "event_date", "2024-13-05", "not a date"), ("E3", "revenue", "1.5 EUR", "not a number"),
        ("E4", None, None, "malformed line"), ("E5", None, None, "malformed line"),
    }
    assert [r.raw for r in read.rejects.collect() if r.reason == "malformed line"][0].endswith("Card,extra")
    with pytest.raises(ValueError, match="4 of 5 rows"):
        read_csv_checked(spark, str(path), "events", max_bad_share=0.5)


def test_checked_ingest_publishes_all_or_nothing(spark, tmp_path):
    from cohortlab.sources.io import ingest_csv_checked, load_published

    (tmp_path / "events.csv").write_text(CSV)
    (tmp_path / "users.csv").write_text("user_id,signup_date,country,city,platform,acquisition_channel,age_group,experiment_group,first_device_type\nU1,2024-01-01,DE,B,iOS,Organic,,control,iOS\n")
    (tmp_path / "experiments.csv").write_text("user_id,experiment_name,experiment_group,exposure_date,converted,conversion_date,days_to_conversion\nU1,x,control,2024-01-01,True,2024-01-03,2.0\nU2,x,control,2024-01-01,perhaps,,2.5\n")
    out = str(tmp_path / "out")
    with pytest.raises(ValueError):
        ingest_csv_checked(spark, str(tmp_path), out)
    with pytest.raises(FileNotFoundError):
        load_published(spark, out)
    counts = ingest_csv_checked(spark, str(tmp_path), out, max_bad_share=0.9)
    assert counts == {"users": {"rows": 1, "rejected_cells": 0}, "events": {"rows": 1, "rejected_cells": 5}, "experiments": {"rows": 1, "rejected_cells": 2}}
    t = load_published(spark, out)
    assert (t.users.count(), t.events.count(), t.experiments.first().days_to_conversion) == (1, 1, 2)
    assert ingest_csv_checked(spark, str(tmp_path), out, max_bad_share=0.9) == counts


def test_reports_run_on_published_tables(spark, tmp_path):
    from cohortlab.reports import run_reports, stored_user_days
    from cohortlab.sources.io import load_published, publish_tables
    from cohortlab.sources.schema import Tables

    t = canonical(spark)
    src = str(tmp_path / "src")
    changed = publish_tables(Tables(t.users, t.events, t.experiments), src)
    assert changed["users"] == ["all"] and len(changed["events"]) > 12
    names = ["kpi_mau", "kpi_executive_churn", "funnel", "retention_by_all_dims", "cohort_revenue_cumulative"]
    kept = run_reports(load_published(spark, src), str(tmp_path / "a"), names=names, user_days=stored_user_days(spark, src))
    plain = run_reports(t, str(tmp_path / "b"), names=names, use_facts=False)
    for n in names:
        assert sorted(map(repr, spark.read.parquet(kept[n]).collect())) == sorted(map(repr, spark.read.parquet(plain[n]).collect())), n
    assert stored_user_days(spark, src).count() > 0  # the kept facts stay


