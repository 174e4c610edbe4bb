"""Funnel operators (U1–U6).

Stage reach is *independent lifetime reach*: a user reaches a stage when they
ever fired its event, regardless of order.  All variants start from one
per-user flag aggregate over the funnel events, so the work is a single
partial+final hash aggregate on ``user_id`` and the funnel itself is a tiny
one-row-per-stage frame built with ``inline`` (no window over raw data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import flag, pct_expr_sql, rnd_pct, rnd_sql
from cohortlab.plans.facts import user_facts, flag_name, user_event_flags
from cohortlab.plans.scale import scalars
from cohortlab.sources.schema import DEFAULT_TAXONOMY, Taxonomy


def _stage_counts(events: DataFrame, names) -> DataFrame:
    """One row: number of distinct users per funnel event (0 on empty input)."""
    flags = user_event_flags(events, names)
    return flags.agg(
        *[F.coalesce(F.sum(flag_name(n)), F.lit(0)).cast("long").alias(f"n_{i}") for i, n in enumerate(names, start=1)]
    )


def funnel_counts(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """U1 — funnel_stage, users_reached (distinct users per stage)."""
    names = list(tax.funnel)
    row = scalars(users.agg(F.count_distinct("user_id").cast("long").alias("n_0")), _stage_counts(events, names))
    labels = list(tax.funnel_labels)
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(labels[i]).alias("funnel_stage"), F.col(f"n_{i}").alias("users_reached"))
                    for i in range(len(labels))
                ]
            )
        )
    )


def _stages_sql(labels, digits, drop_from_share: bool) -> str:
    """``inline(array(named_struct(...)))`` over count columns ``n_0 … n_k``:
    one row per stage with its share of the top stage and of the previous
    stage, and the drop-off (NULL for the first stage).

    ``drop_from_share`` computes the drop-off as ``100 − share of previous``;
    otherwise as ``100 · (previous − reached) / previous``."""
    structs = []
    for i, label in enumerate(labels):
        c = f"n_{i}"
        top = rnd_sql(pct_expr_sql(c, "n_0"), digits)
        if i == 0:
            prev = drop = "CAST(NULL AS DOUBLE)"
        else:
            p = f"n_{i - 1}"
            prev = rnd_sql(pct_expr_sql(c, p), digits)
            drop = rnd_sql("100.0D - " + pct_expr_sql(c, p), digits) if drop_from_share else rnd_sql(pct_expr_sql(f"{p} - {c}", p), digits)
        structs.append(
            f"named_struct('stage', '{label}', 'stage_order', {i + 1}, 'users', {c}, "
            f"'pct_top', {top}, 'pct_prev', {prev}, 'drop_off', {drop})"
        )
    return "inline(array(" + ", ".join(structs) + "))"


def compute_funnel(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY, digits: int = 1, subset: DataFrame | None = None) -> DataFrame:
    """U2 — stage, users_reached, pct_of_top_of_funnel, pct_of_previous_stage,
    drop_off_pct_vs_previous (first stage: NULL for the last two).

    ``subset`` (a frame with ``user_id``) restricts the funnel to its users."""
    if subset is not None:
        chosen = subset.select("user_id")
        # one row per user first, so no raw events reach the join
        users, events = users.join(chosen, "user_id", "left_semi"), user_facts(events, tax=tax).join(chosen, "user_id", "left_semi")
    names = list(tax.funnel)
    row = scalars(users.agg(F.count(F.lit(1)).alias("n_0")), _stage_counts(events, names))
    return row.selectExpr(_stages_sql(list(tax.funnel_labels), digits, drop_from_share=False)).selectExpr(
        "stage",
        "users AS users_reached",
        "pct_top AS pct_of_top_of_funnel",
        "pct_prev AS pct_of_previous_stage",
        "drop_off AS drop_off_pct_vs_previous",
    )


def funnel_by(users: DataFrame, events: DataFrame, dim: str, tax: Taxonomy = DEFAULT_TAXONOMY, digits: int = 2) -> DataFrame:
    """U3 — the funnel computed for every value of ``dim`` in one pass.

    Per value: users in the segment, and users of the segment that fired each
    funnel event (events are restricted to the segment's users).  Output: dim,
    stage, stage_order, users, pct_of_signups, pct_of_previous_stage,
    drop_off_pct (= 100 − pct_of_previous_stage, unrounded inputs).
    """
    names = list(tax.funnel)
    flags = user_event_flags(events, names)
    per_dim = (
        users.select("user_id", dim)
        .join(flags, "user_id", "left")
        .groupBy(dim)
        .agg(
            F.count_distinct("user_id").cast("long").alias("n_0"),
            *[
                F.coalesce(F.sum(flag_name(n)), F.lit(0)).cast("long").alias(f"n_{i}")
                for i, n in enumerate(names, start=1)
            ],
        )
    )
    q = "`" + dim.replace("`", "``") + "`"
    return per_dim.selectExpr(q, _stages_sql(list(tax.funnel_labels), digits, drop_from_share=True)).selectExpr(
        q,
        "stage",
        "stage_order",
        "users",
        "pct_top AS pct_of_signups",
        "pct_prev AS pct_of_previous_stage",
        "drop_off AS drop_off_pct",
    )


def attempt_outcomes(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """U4 — event-level booking attempts and outcome rates (one row)."""
    name = F.col("event_name")
    ev = events.filter(name.isin(tax.booking_started, tax.booking_completed, tax.booking_cancelled, tax.payment_failed))
    counts = ev.agg(
        F.count_if(name == tax.booking_started).alias("booking_attempts"),
        F.count_if(name == tax.booking_completed).alias("completed"),
        F.count_if(name == tax.booking_cancelled).alias("cancelled"),
        F.count_if(name == tax.payment_failed).alias("payment_failed"),
    )
    return counts.select(
        "*",
        rnd_pct("cancelled", "booking_attempts", 1).alias("cancellation_rate_pct"),
        rnd_pct("completed", "booking_attempts", 1).alias("booking_completion_rate_pct"),
    )


def abandonment(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY, start: str | None = None, goal: str | None = None) -> DataFrame:
    """U5 — last event of sessions that fired ``start`` but never ``goal``.

    Events are first reduced to the latest time of each event name in a
    session (a hash aggregate with a fixed-width buffer); a session is then
    at most one row per event name, from which both flags and the last event
    are taken.  Of several events at the last time, the one whose name comes
    last counts.  Output: last_event_reached, session_count,
    pct_of_non_converting_sessions.
    """
    start = start or tax.search_started
    goal = goal or tax.booking_completed
    name = F.col("event_name")
    latest = events.groupBy("session_id", "event_name").agg(F.max("event_time").alias("_t"))
    sessions = latest.groupBy("session_id").agg(
        F.max(flag(name == start)).alias("_start"),
        F.max(flag(name == goal)).alias("_goal"),
        F.max(F.struct("_t", "event_name"))["event_name"].alias("last_event_reached"),
    )
    lost = sessions.filter((F.col("_start") == 1) & (F.col("_goal") == 0))
    per_event = lost.groupBy("last_event_reached").agg(F.count(F.lit(1)).alias("session_count"))
    total = per_event.agg(F.sum("session_count").alias("_total"))
    return per_event.join(F.broadcast(total), how="inner").select(
        "last_event_reached",
        "session_count",
        rnd_pct("session_count", "_total", 1).alias("pct_of_non_converting_sessions"),
    )


def step_rates(users: DataFrame, events: DataFrame, dim: str = "acquisition_channel", tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """U6 — per segment: signups, searched, booking_started, booked and the
    step-over-step rates (1 dp)."""
    names = [tax.search_started, tax.booking_started, tax.booking_completed]
    flags = user_event_flags(events, names)
    per = (
        users.select("user_id", dim)
        .join(flags, "user_id", "left")
        .groupBy(dim)
        .agg(
            F.count_distinct("user_id").cast("long").alias("signups"),
            F.coalesce(F.sum(flag_name(names[0])), F.lit(0)).cast("long").alias("searched"),
            F.coalesce(F.sum(flag_name(names[1])), F.lit(0)).cast("long").alias("booking_started"),
            F.coalesce(F.sum(flag_name(names[2])), F.lit(0)).cast("long").alias("booked"),
        )
    )
    return per.select(
        dim,
        "signups",
        "searched",
        "booking_started",
        "booked",
        rnd_pct("searched", "signups", 1).alias("search_rate_pct"),
        rnd_pct("booking_started", "searched", 1).alias("booking_start_rate_pct"),
        rnd_pct("booked", "booking_started", 1).alias("booking_completion_rate_pct"),
        rnd_pct("booked", "signups", 1).alias("overall_conversion_pct"),
    )
