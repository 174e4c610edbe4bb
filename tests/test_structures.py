"""Activity bitmaps, radix selection, seen-twice tables, one-pass families."""

import datetime as dt
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import D, TS, events_df, users_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlab.operators import all_dims, retention as ret, segments
from cohortlab.plans import activity, repeats, selection


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


# --- activity bitmaps ---------------------------------------------------------
def people(spark, span, n=80, seed=1):
    rnd = random.Random(seed)
    first = D(2023, 11, 20)
    users = users_df(spark, [(f"U{i}", first + dt.timedelta(days=rnd.randrange(-10, span)), "DE", rnd.choice(["iOS", "Web"]), "Organic", None, "control", "iOS") for i in range(n)])
    days = [(f"U{rnd.randrange(n + 5)}", first + dt.timedelta(days=rnd.randrange(span))) for _ in range(20 * n)]
    rows = [(f"E{i}", u, dt.datetime.combine(d, dt.time(9)), "S", "app_open", None) for i, (u, d) in enumerate(days)]
    return users, events_df(spark, rows)


@pytest.mark.parametrize("span", [1, 64, 65, 200, 9000])
def test_bitmap_reports_equal_event_reports(spark, span):
    users, events = people(spark, span)
    bitmap = activity.activity_bitmap(events)
    for report in (
        lambda e: ret.compute_retention_flags(users, e, (0, 1, 7, 30, 400)),
        lambda e: ret.retention(users, e, (1, 7, 63)),
        lambda e: ret.retention_by(users, e, "platform", (0, 64)),
        lambda e: ret.retention_curve(users, e, max_day=70),
        lambda e: ret.cohort_retention(users, e),
    ):
        same(report(events), report(bitmap))


def test_bitmap_takes_one_shuffle_of_events(spark):
    users, events = people(spark, 200)
    bitmap = activity.activity_bitmap(events, D(2023, 11, 20), D(2024, 6, 6))
    assert plan(bitmap).count("Exchange") == 1 and "partial_bit_or" in plan(bitmap)
    flags = plan(ret.compute_retention_flags(users, bitmap))
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", flags)) <= 2  # events and users, by user
    row = bitmap.first()
    assert len(row.words) == 4 and row.base == D(2023, 11, 20)


def test_bitmap_of_nothing_and_of_days_outside(spark):
    users, events = people(spark, 30)
    assert ret.retention(users, activity.activity_bitmap(events.limit(0)), (1,)).first().day1_retained_users == 0
    inside = activity.activity_bitmap(events, D(2023, 11, 25), D(2023, 12, 1))
    same(ret.retention_curve(users, inside, 20), ret.retention_curve(users, events.filter("event_date between '2023-11-25' and '2023-12-01'"), 20))


# --- selection ----------------------------------------------------------------
def bits_of(v):
    size = int(np.float64(abs(v)).view(np.int64)) if v == v else (2047 << 52) + 1
    return -size if v < 0 else size


def test_ordered_bits_are_those_of_the_double(spark):
    rnd = random.Random(1)
    vals = [0.0, -0.0, 5e-324, 1e-310, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan]
    vals += [math.ldexp(rnd.random() * 2 - 1, rnd.randrange(-1070, 1020)) for _ in range(2000)]
    vals += [s * 2.0**k for k in range(-1074, 1024) for s in (1, -1)] + [float(np.nextafter(2.0**k, 0)) for k in range(-1022, 1024)]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").select("v", selection.ordered_bits(F.col("v")).alias("k"))
    assert [r for r in df.collect() if r.k != bits_of(r.v)] == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=32), st.sampled_from([0.0, 1.0, 1.0, 2.5])), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, vals):
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(vals)], "v double, g int").withColumn("g", F.when(F.col("g") == 0, 0))
    got = {r.g: (r._n, r.q0, r.q1, r.q2) for r in selection.selected_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    for g in {i % 2 for i in range(len(vals))}:
        mine = [float(v) for i, v in enumerate(vals) if i % 2 == g]
        n, *q = got[0 if g == 0 else None]
        assert n == len(mine) and np.allclose(q, np.quantile(mine, [0.25, 0.5, 0.9]), rtol=1e-9, atol=1e-300)


def test_selection_of_wide_values_ends_after_six_passes(spark, monkeypatch):
    rnd = random.Random(2)
    vals = [math.ldexp(rnd.random() - 0.5, rnd.randrange(-900, 900)) for _ in range(3000)] + [1.0 + i * 2.0**-52 for i in range(3000)]
    passes, real = [], selection.staged
    monkeypatch.setattr(selection, "staged", lambda df: passes.append(df) or real(df))
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = selection.selected_quantiles(df, "v", [0.0, 0.6, 0.61, 1.0]).first()
    assert np.allclose([r.q0, r.q1, r.q2, r.q3], np.quantile(vals, [0.0, 0.6, 0.61, 1.0]), rtol=1e-15)
    histograms = [p for p in passes if "_n" in p.columns and "_c" in p.columns]
    assert len(histograms) <= 6 and all("Sort [_v" not in plan(p) for p in histograms)


def test_selection_skips_nulls_and_empty_groups(spark):
    df = spark.createDataFrame([("a", None), ("a", 3.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in selection.selected_quantiles(df, "v", [0.5], ["g"]).collect()] == [("a", 1, 3.0)]
    assert selection.selected_quantiles(df.filter("false"), "v", [0.5], ["g"]).count() == 0


def test_describe_neither_sorts_nor_stores_values(spark):
    df = spark.createDataFrame([(float(i % 97), None if i % 5 else 2.0) for i in range(4000)], "a double, b double")
    got = {r.column: r for r in segments.describe(df, ["a", "b"]).collect()}
    assert got["a"].p25 == np.quantile([i % 97 for i in range(4000)], 0.25) and (got["b"].p50, got["b"]["count"]) == (2.0, 800)
    assert "Exchange rangepartitioning" not in plan(segments.describe(df, ["a"]))


# --- keys that repeat ----------------------------------------------------------
def keyed(spark, n=20000, parts=7):
    rnd = random.Random(1)
    data = [(rnd.choice([None, rnd.randrange(n // 2)]) if i % 10 == 0 else n + i, rnd.choice("ab")) for i in range(n)]
    return data, spark.createDataFrame(data, "k long, x string").repartition(parts)


@pytest.mark.parametrize("bits", [None, 15, 20])
def test_repeated_keys_are_exact_also_with_forced_collisions(spark, bits):
    data, df = keyed(spark)
    got = {r.k: r.occurrences for r in repeats.repeated_keys(df, ["k"], bits).collect()}
    assert got == {k: n for k, n in Counter(k for k, _ in data).items() if n > 1}
    if bits == 15:  # 20,000 keys in 32,768 slots: unique keys share slots, and are not reported
        assert repeats.suspects(df, ["k"], bits).count() > 3 * sum(got.values())


def test_composite_keys_and_tables_of_many_tasks(spark):
    data, df = keyed(spark, n=3000, parts=150)  # more tasks than one merge takes
    got = {(r.k, r.x): r.occurrences for r in repeats.repeated_keys(df, ["k", "x"]).collect()}
    assert got == {k: n for k, n in Counter(data).items() if n > 1}
    assert repeats.repeated_keys(df.limit(0), ["k"]).count() == 0


def test_only_suspects_are_shuffled(spark):
    _, df = keyed(spark)
    rows = repeats.suspects(df, ["k"])
    assert rows.count() < 0.2 * df.count()  # a tenth repeats, a sixteenth of the rest shares a slot
    text = plan(repeats.repeated_keys(df, ["k"]))
    assert text.index("HashAggregate") < text.index("hashpartitioning(k") < text.index("BroadcastHashJoin")


def test_a_table_that_would_be_full_is_left_out(spark, monkeypatch):
    data, df = keyed(spark, n=2000)
    monkeypatch.setattr(repeats, "MAX_BITS", 8)
    got = {r.k: r.occurrences for r in repeats.repeated_keys(df, ["k"]).collect()}
    assert got == {k: n for k, n in Counter(k for k, _ in data).items() if n > 1}


def test_memory_of_a_seen_twice_table_is_two_bits_a_slot_however_many_tasks():
    rnd = np.random.default_rng(3)
    slots = [rnd.integers(0, 1 << 24, 5000) for _ in range(40)]
    batches = lambda i: iter([pa.RecordBatch.from_arrays([pa.array(s)], names=["s"]) for s in slots[i::10]])
    tracemalloc.start()
    filled = [b.num_rows for b in repeats._filler(24)(batches(0))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    groups = {}
    for i in range(10):
        for b in repeats._filler(24)(batches(i)):
            groups.setdefault(b.column(0)[0].as_py() >> 5, []).append(b)
    merged = [b for g in groups.values() for b in repeats._merged(iter(g))]
    tracemalloc.stop()
    assert sum(filled) == 512 and most < 2 * (1 << 24) / 4
    got = {(run << 15) + 64 * w + bit for b in merged for run, words in zip(b["run"].to_pylist(), b["again"].to_pylist()) for w, x in enumerate(words) for bit in range(64) if x >> bit & 1}
    assert got == {s for s, n in Counter(np.concatenate(slots).tolist()).items() if n > 1}


# --- every dimension in one pass ------------------------------------------------
def test_all_dims_equal_the_tables_by_dimension_from_one_events_scan(spark):
    from cohortlab.operators import kpi
    from cohortlab.sources.testdata import clickstream

    t = clickstream(spark, "/root/testdata/sf0.001")
    dims = {"country": None, "age_group": "Unspecified", "platform": None}
    plain = dict.fromkeys(dims)
    for both, one in (
        (all_dims.composition_by_all(t.users, dims), lambda d: kpi.composition(t.users, d, null_label=dims[d])),
        (all_dims.revenue_by_all(t.users, t.events, plain), lambda d: kpi.revenue_by(t.users, t.events, d)),
        (all_dims.segment_summary_all(t.users, t.events, dims), lambda d: segments.segment_summary(t.users, t.events, d, dims[d])),
        (all_dims.retention_by_all(t.users, t.events, plain, (1, 7)), lambda d: ret.retention_by(t.users, t.events, d, (1, 7))),
    ):
        rows = {}
        for r in both.collect():
            rows.setdefault(r.dim, []).append(tuple(r)[1:])
        for d in dims:
            assert sorted(map(repr, rows[d])) == sorted(repr(tuple(r)) for r in one(d).collect())
    users = users_df(spark, [("U1", D(2024, 1, 1), "DE", "iOS", "Organic", None, "control", "iOS")])
    events = events_df(spark, [("E1", "U1", TS(2024, 1, 2), "S", "booking_completed", 3.0)])
    assert plan(all_dims.segment_summary_all(users, events)).count("Scan ExistingRDD[event_id") == 1


def test_running_sum_on_the_dense_spine(spark):
    users = users_df(spark, [(u, s, "DE", "iOS", "Organic", None, "control", "iOS") for u, s in (("A", D(2024, 1, 3)), ("B", D(2024, 1, 9)), ("C", D(2024, 3, 1)))])
    pay = lambda i, u, m, x: (f"E{i}", u, TS(2024, m, 20), "S", "booking_completed", x)
    events = events_df(spark, [pay(1, "A", 1, 10.0), pay(2, "A", 3, 5.0), pay(3, "B", 3, 2.5), pay(4, "C", 4, 4.0), ("E5", "X", TS(2024, 5, 1), "S", "app_open", None)])
    got = {(r.cohort_month, r.months_since_signup): (r.revenue_eur, r.cumulative_revenue_eur, r.cumulative_per_cohort_user_eur) for r in ret.cohort_revenue_cumulative(users, events).collect()}
    jan, mar = "2024-01", "2024-03"
    assert got == {
        (jan, 0): (10.0, 10.0, 5.0), (jan, 1): (0.0, 10.0, 5.0), (jan, 2): (7.5, 17.5, 8.75), (jan, 3): (0.0, 17.5, 8.75), (jan, 4): (0.0, 17.5, 8.75),
        (mar, 0): (0.0, 0.0, 0.0), (mar, 1): (4.0, 4.0, 4.0), (mar, 2): (0.0, 4.0, 4.0), (mar, 3): (None, None, None), (mar, 4): (None, None, None),
    }
    assert ret.cohort_revenue_cumulative(users, events.limit(0)).count() == 0


# --- mergeable moments ------------------------------------------------------------
def test_moments_are_the_same_to_the_last_bit_however_rows_are_dealt(spark):
    from cohortlab.plans import moments as M

    rnd = random.Random(3)
    vals = [(rnd.choice("ab"), i % 7, round(rnd.expovariate(0.01), rnd.randrange(9)), rnd.gauss(5, 2) if i % 11 else None) for i in range(4000)]
    df = spark.createDataFrame(vals, "arm string, day int, x double, y double")

    def result(rows):
        total = M.merged(rows.groupBy("day", "arm").agg(*M.sums("x")), ["arm"])
        return sorted(tuple(r) for r in total.select("arm", "n", "s1", "s2", M.variance(0), M.variance(1)).collect())

    want = result(df.repartition(1))
    assert result(df.repartition(7)) == result(df.repartition(200, "x")) == want
    slices = [df.filter(f"day = {d}").groupBy("day", "arm").agg(*M.sums("x")) for d in range(7)]
    merged = slices[0]
    for s in slices[1:]:
        merged = s.unionByName(merged)
    total = M.merged(merged, ["arm"])
    assert sorted(tuple(r) for r in total.select("arm", "n", "s1", "s2", M.variance(0), M.variance(1)).collect()) == want
    for arm, n, _, _, pop, samp in want:
        mine = [v[2] for v in vals if v[0] == arm]
        assert n == len(mine) and np.allclose([pop, samp], [np.var(mine), np.var(mine, ddof=1)], rtol=1e-9)
    corr = [{tuple(r) for r in segments.corr_matrix(df.repartition(n), ["x", "y"]).collect()} for n in (1, 7, 200)]
    assert corr[0] == corr[1] == corr[2]
    pairs = [(v[2], v[3]) for v in vals if v[3] is not None]
    got = {(a, b): c for a, b, c in corr[0]}
    assert got["x", "y"] == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-9) and got["x", "x"] == 1.0


def test_small_spread_beside_a_large_mean_and_degenerate_groups(spark):
    from cohortlab.plans import moments as M

    df = spark.createDataFrame([("a", 1e9 + 0.25 * (i % 4)) for i in range(1000)] + [("b", 5.0), ("c", None)], "g string, x double")
    got = {r.g: tuple(r)[1:] for r in df.groupBy("g").agg(*M.sums("x")).select("g", M.variance(0), M.variance(1)).collect()}
    assert got["a"] == (0.078125, 0.078125 * 1000 / 999) and got["b"] == (0.0, None) and got["c"] == (None, None)
    one = segments.corr_matrix(spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double"), ["x", "y"]).collect()
    assert {(r.feature_x, r.feature_y): r.correlation for r in one}["y", "y"] == 1.0
    with pytest.raises(Exception, match="(?i)out of range|cannot be represented|overflow"):
        df.select((F.col("x") * 100).alias("x")).agg(*M.sums("x")).collect()
