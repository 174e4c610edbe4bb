"""Facts kept by event month and brought up to date month by month.

``events`` is a :class:`VersionedTable` by month.  The (user, day) facts of a
month depend on that month's events only, and so do the day sketches: when a
slice of events arrives, the months it touches are built again and the others
stay.  Per-user facts are rolled up from the (user, day) facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import month_key, week_key
from cohortlab.plans.facts import user_day_facts
from cohortlab.sources.schema import EVENT_NAMES
from cohortlab.sources.versions import VersionedTable, refresh

#: Sketches have 2 ** LG_K buckets of 4 bits and more: about 2 to 8 KB each.
LG_K = 12
#: Stated bound of the relative error: three standard errors of 1.04 / sqrt(2 ** LG_K).
ERROR_BOUND = 0.05


def event_month() -> F.Column:
    return month_key("event_date")


def add_events(events: VersionedTable, rows: DataFrame) -> list[str]:
    """Add a slice of events: each month it touches is published again with
    its old rows and the new ones.  An event that is already there (the same
    event_id, and all its columns the same) is not added twice, so a slice may
    be loaded again.  Returns the months that changed."""
    months = sorted(r[0] or "null" for r in rows.select(event_month().alias("m")).distinct().collect())
    if events.manifest()["number"]:
        old = events.read(months).select(rows.columns)
        same = [old[c].eqNullSafe(rows[c]) for c in rows.columns]
        cond = same[0]
        for s in same[1:]:
            cond = cond & s
        rows = old.unionByName(rows.join(old, cond, "left_anti"))
    return events.publish(rows, event_month(), keep_others=True)


def refresh_user_days(events: VersionedTable, facts: VersionedTable, names=EVENT_NAMES) -> list[str]:
    """(user, day) facts of the months of ``events`` that changed since."""
    return refresh(events, facts, lambda rows: user_day_facts(rows, names=names), event_month())


def day_sketches(days: DataFrame, users: DataFrame, dim: str, lg_k: int = LG_K) -> DataFrame:
    """(event_date, <dim>, sketch): one HyperLogLog sketch of the active users
    per day and value of a column of users.  ``days`` has a row per user and
    day (or more: a sketch counts a user once); users who are unknown or have
    no value are in the null group."""
    known = users.select("user_id", dim)
    return days.select("user_id", "event_date").join(known, "user_id", "left").groupBy("event_date", dim).agg(F.hll_sketch_agg("user_id", lg_k).alias("sketch"))


def refresh_sketches(facts: VersionedTable, sketches: VersionedTable, users: DataFrame, dim: str, lg_k: int = LG_K) -> list[str]:
    """Day sketches of the months of (user, day) facts that changed since."""
    return refresh(facts, sketches, lambda days: day_sketches(days, users, dim, lg_k), event_month())


_PERIODS = {"day": lambda: F.date_format("event_date", "yyyy-MM-dd"), "week_mon": lambda: week_key("event_date"), "month": event_month}


def sketched_actives(sketches: DataFrame, dim: str | None = None, grains=("day", "week_mon", "month")) -> DataFrame:
    """K8–K10 from day sketches: grain, period, (<dim>,) estimate.  The
    sketches of a period's days are united: no event, and no user, is read.
    A period without events has no row."""
    keys = [dim] if dim else []
    out = []
    for grain in grains:
        united = sketches.groupBy(_PERIODS[grain]().alias("period"), *keys).agg(F.hll_union_agg("sketch").alias("s"))
        out.append(united.select(F.lit(grain).alias("grain"), "period", *keys, F.hll_sketch_estimate("s").alias("estimate")))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


def exact_actives(days: DataFrame, users: DataFrame, dim: str | None = None, grains=("day", "week_mon", "month")) -> DataFrame:
    """What :func:`sketched_actives` estimates, exactly: grain, period,
    (<dim>,) actives."""
    rows = days.select("user_id", "event_date")
    if dim:
        rows = rows.join(users.select("user_id", dim), "user_id", "left")
    keys, out = ([dim] if dim else []), None
    for grain in grains:
        per = rows.select(_PERIODS[grain]().alias("period"), *keys, "user_id").distinct().groupBy("period", *keys).agg(F.count(F.lit(1)).alias("actives"))
        per = per.select(F.lit(grain).alias("grain"), "period", *keys, "actives")
        out = per if out is None else out.unionByName(per)
    return out


def compare_actives(sketches: DataFrame, days: DataFrame, users: DataFrame, dim: str, bound: float = ERROR_BOUND) -> DataFrame:
    """Estimate and exact count of every period and value of ``dim``, and
    whether they differ by at most ``bound`` of the count (or one user)."""
    near = sketched_actives(sketches, dim).withColumnRenamed(dim, "_d")
    rows = exact_actives(days, users, dim)
    both = rows.join(near, (rows["grain"] == near["grain"]) & (rows["period"] == near["period"]) & rows[dim].eqNullSafe(near["_d"]), "full")
    off = F.abs(F.col("estimate") - F.col("actives"))
    within = F.coalesce(off <= F.greatest(F.lit(1.0), F.col("actives") * bound), F.lit(False))
    return both.select(rows["grain"], rows["period"], dim, "actives", "estimate", within.alias("within_bound"))
