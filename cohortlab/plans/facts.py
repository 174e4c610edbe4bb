"""Shared per-user / per-session / per-day fact frames.

Every fact is one hash aggregate over ``events`` keyed by the entity.  Spark
runs it as partial (map-side) + final aggregation, so an entity that owns a
large share of all events is reduced inside each map task before the shuffle
— a hot user or session never lands in one task as raw rows.  Catalyst prunes
the aggregate columns a caller does not use, so callers take what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import amount, day_offset, flag
from cohortlab.plans.activity import active_on, is_activity_bitmap
from cohortlab.sources.schema import DEFAULT_TAXONOMY, Taxonomy


def flag_name(event_name: str) -> str:
    return f"has_{event_name}"


def is_user_facts(df: DataFrame) -> bool:
    """True for the per-user fact table built by :func:`user_facts`."""
    return "_user_facts" in df.columns


def user_event_flags(events: DataFrame, names) -> DataFrame:
    """Per user: ``has_<name>`` 0/1 for each event name (one pass).

    ``events`` may be raw events (only the named events are read) or the
    per-user fact table of :func:`user_facts` (its flags are projected)."""
    if is_user_facts(events):
        return events.select("user_id", *[flag_name(n) for n in names])
    ev = events.filter(F.col("event_name").isin(*names))
    return ev.groupBy("user_id").agg(*[F.max(flag(F.col("event_name") == n)).alias(flag_name(n)) for n in names])


def user_bookings(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """Per paying user: bookings, booking ids, revenue, bookings with
    revenue.  Accepts raw events or the per-user fact table."""
    cols = ["bookings", "booking_ids", "revenue", "revenue_rows"]
    if is_user_facts(events):
        return events.filter(F.col("bookings") > 0).select("user_id", *cols)
    return (
        events.filter(F.col("event_name") == tax.booking_completed)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("bookings"),
            F.count("event_id").alias("booking_ids"),
            F.sum(amount("revenue")).alias("revenue"),
            F.count("revenue").alias("revenue_rows"),
        )
    )


def user_facts(events: DataFrame, names=None, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """One row per active user: ``has_<name>`` for every tracked event name,
    bookings, booking ids, revenue and revenue rows — one aggregate
    over events.  Operators built on :func:`user_event_flags` /
    :func:`user_bookings` accept this table in place of ``events``, so a job
    running many per-user reports scans events once (see
    ``cohortlab.reports``)."""
    from cohortlab.sources.schema import EVENT_NAMES

    names = list(names or EVENT_NAMES)
    name = F.col("event_name")
    booking = name == tax.booking_completed
    return events.groupBy("user_id").agg(
        *[F.max(flag(name == n)).alias(flag_name(n)) for n in names],
        F.count_if(booking).alias("bookings"),
        F.count(F.when(booking, F.col("event_id"))).alias("booking_ids"),
        F.sum(F.when(booking, amount("revenue"))).alias("revenue"),
        F.count(F.when(booking, F.col("revenue"))).alias("revenue_rows"),
        F.lit(1).alias("_user_facts"),
    )


def user_facts_from_days(days: DataFrame) -> DataFrame:
    """:func:`user_facts` rolled up from a :func:`user_day_facts` table."""
    flags = [c for c in days.columns if c.startswith("has_")]
    sums = ("bookings", "booking_ids", "revenue", "revenue_rows")
    return days.groupBy("user_id").agg(*[F.max(c).alias(c) for c in flags], *[F.sum(c).alias(c) for c in sums], F.lit(1).alias("_user_facts"))


def user_activity(events: DataFrame) -> DataFrame:
    """Per active user: event count and last event date."""
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_events"), F.max("event_date").alias("last_event_date")
    )


def user_offsets(users: DataFrame, events: DataFrame, names=None) -> DataFrame:
    """Distinct (user_id, days_since_signup) for users present in both tables.

    Events are first reduced to distinct (user, date) pairs (optionally only
    for ``names``), so the join to users sees at most one row per active day.
    """
    ev = events if names is None else events.filter(F.col("event_name").isin(*names))
    days = ev.select("user_id", "event_date").distinct()
    return (
        days.join(users.select("user_id", "signup_date"), "user_id")
        .select("user_id", day_offset("event_date", "signup_date").alias("days_since_signup"))
    )


def retention_flags(users: DataFrame, events: DataFrame, days=(1, 7, 30), keep=()) -> DataFrame:
    """T0 — one row per user with ``retained_day<N>`` 0/1 flags (never-active → 0).

    ``events`` may be the table of :func:`activity_bitmap`: the flags are then
    bit tests on the user's row."""
    if is_activity_bitmap(events):
        signup = F.datediff("signup_date", F.col("base"))
        own = users.select("user_id", "signup_date", *keep).join(events.select("user_id", "base", "words"), "user_id", "left")
        return own.select("user_id", *keep, *[flag(active_on(signup + d)).alias(f"retained_day{d}") for d in days])
    offs = user_offsets(users, events).filter(F.col("days_since_signup").isin(*days))
    per_user = offs.groupBy("user_id").agg(
        *[F.max(flag(F.col("days_since_signup") == d)).alias(f"retained_day{d}") for d in days]
    )
    base = users.select("user_id", *keep)
    out = base.join(per_user, "user_id", "left")
    return out.select(
        "user_id", *keep, *[F.coalesce(F.col(f"retained_day{d}"), F.lit(0)).alias(f"retained_day{d}") for d in days]
    )


def is_user_day_facts(df: DataFrame) -> bool:
    """True for the per-(user, day) fact table built by :func:`user_day_facts`."""
    return "_user_day_facts" in df.columns


def user_day_facts(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY, names=None) -> DataFrame:
    """Per (user, day): event count, ``has_<name>`` flags, bookings, booking
    ids, revenue and revenue rows.

    One partial+final aggregate over events (a hot user collapses to one row
    per active day).  Day-grained operators (activity, retention, cohorts,
    activation, executive rows, adoption vs retention) accept this table in
    place of ``events``; an already built table is returned unchanged.
    ``names`` defaults to the two activation events; the report job builds it
    with every tracked event name."""
    if is_user_day_facts(events):
        return events
    names = list(names or (tax.search_completed, tax.booking_completed))
    name = F.col("event_name")
    booking = name == tax.booking_completed
    return events.groupBy("user_id", "event_date").agg(
        F.count(F.lit(1)).alias("events"),
        *[F.max(flag(name == n)).alias(flag_name(n)) for n in names],
        F.count_if(booking).alias("bookings"),
        F.count(F.when(booking, F.col("event_id"))).alias("booking_ids"),
        F.sum(F.when(booking, amount("revenue"))).alias("revenue"),
        F.count(F.when(booking, F.col("revenue"))).alias("revenue_rows"),
        F.lit(1).alias("_user_day_facts"),
    )
