"""Feature-adoption operators (A1–A5).

A user adopted a feature when they ever fired its event.  Per-user flags for
all features (plus conversion) come from one conditional-max aggregate over
events; per-feature result rows are produced by ``unpivot`` of that one
frame rather than one scan per feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import day_offset, flag, rnd, rnd_pct
from cohortlab.plans.facts import flag_name, is_user_day_facts, user_event_flags
from cohortlab.plans.scale import with_scalars
from cohortlab.sources.schema import DEFAULT_TAXONOMY, Taxonomy


def _user_flags(users: DataFrame, events: DataFrame, names, days=()) -> DataFrame:
    """One row per user: ``has_<name>`` flags (0-filled) and, for ``days``,
    ``retained_day<N>`` flags.

    Without ``days`` only the named events are read.  With ``days`` both kinds
    of flag come from one (user, day) aggregate of events joined to users —
    a single events scan, and at most one row per active day per user reaches
    the join."""
    if not days:
        flags = user_event_flags(events, names)
        return users.select("user_id").join(flags, "user_id", "left").select(
            "user_id", *[F.coalesce(F.col(flag_name(n)), F.lit(0)).alias(flag_name(n)) for n in names]
        )
    if is_user_day_facts(events):
        per_day = events.select("user_id", "event_date", *[flag_name(n) for n in names])
    else:
        name = F.col("event_name")
        per_day = events.groupBy("user_id", "event_date").agg(*[F.max(flag(name == n)).alias(flag_name(n)) for n in names])
    joined = users.select("user_id", "signup_date").join(per_day, "user_id", "left")
    off = day_offset("event_date", "signup_date")
    return joined.groupBy("user_id").agg(
        *[F.coalesce(F.max(flag_name(n)), F.lit(0)).alias(flag_name(n)) for n in names],
        *[F.max(flag(off == d)).alias(f"retained_day{d}") for d in days],
    )


def adoption(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """A1 — feature, adopters, adoption_rate_pct (over all users, 1 dp)."""
    features = list(tax.features)
    flags = user_event_flags(events, features)
    counts = flags.agg(*[F.coalesce(F.sum(flag_name(f)), F.lit(0)).cast("long").alias(f) for f in features])
    total = users.agg(F.count(F.lit(1)).alias("_total"))
    rows = counts.unpivot([], features, "feature", "adopters")
    return with_scalars(rows, total).select("feature", "adopters", rnd_pct("adopters", "_total", 1).alias("adoption_rate_pct"))


def adoption_effect(users: DataFrame, events: DataFrame, days=(7, 30), tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """A2 — per feature × (Adopters | Non-adopters): users, day-N retention %
    and conversion % (1 dp)."""
    features = list(tax.features)
    names = features + [tax.booking_completed]
    uf = _user_flags(users, events, names, days).withColumnRenamed(flag_name(tax.booking_completed), "_converted")
    long = uf.unpivot(
        ["user_id", "_converted", *[f"retained_day{d}" for d in days]],
        [flag_name(f) for f in features],
        "_feature_col",
        "_adopted",
    )
    agg = long.groupBy("_feature_col", "_adopted").agg(
        F.count(F.lit(1)).alias("users"),
        *[F.avg(F.col(f"retained_day{d}").cast("int")).alias(f"_r{d}") for d in days],
        F.avg(F.col("_converted").cast("int")).alias("_conv"),
    )
    return agg.select(
        F.regexp_replace("_feature_col", "^has_", "").alias("feature"),
        F.when(F.col("_adopted") == 1, F.lit("Adopters")).otherwise(F.lit("Non-adopters")).alias("segment"),
        "users",
        *[rnd(F.lit(100.0) * F.col(f"_r{d}"), 1).alias(f"day{d}_retention_pct") for d in days],
        rnd(F.lit(100.0) * F.col("_conv"), 1).alias("conversion_rate_pct"),
    )


def adoption_by(users: DataFrame, events: DataFrame, dim: str = "platform", tax: Taxonomy = DEFAULT_TAXONOMY, labels=None) -> DataFrame:
    """A3 — per ``dim``: total users and adoption % (1 dp) of each feature."""
    features = list(tax.features)
    labels = labels or {
        "notification_enabled": "notification_adoption_pct",
        "favourite_location_added": "favourite_adoption_pct",
        "promo_viewed": "promo_view_adoption_pct",
    }
    uf = _user_flags(users, events, features).join(users.select("user_id", dim), "user_id")
    agg = uf.groupBy(dim).agg(
        F.count(F.lit(1)).alias("total_users"), *[F.avg(F.col(flag_name(f)).cast("int")).alias(f"_a{i}") for i, f in enumerate(features)]
    )
    return agg.select(
        dim,
        "total_users",
        *[rnd(F.lit(100.0) * F.col(f"_a{i}"), 1).alias(labels.get(f, f"{f}_adoption_pct")) for i, f in enumerate(features)],
    )


def adoption_depth(users: DataFrame, events: DataFrame, day: int = 30, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """A4 — features_adopted (0..k), users, day-``day`` retention % (1 dp)."""
    features = list(tax.features)
    uf = _user_flags(users, events, features, (day,))
    n = sum((F.col(flag_name(f)) for f in features), F.lit(0))
    agg = uf.groupBy(n.cast("long").alias("features_adopted")).agg(
        F.count(F.lit(1)).alias("users"), F.avg(F.col(f"retained_day{day}").cast("int")).alias("_r")
    )
    return agg.select("features_adopted", "users", rnd(F.lit(100.0) * F.col("_r"), 1).alias(f"day{day}_retention_pct"))


def adoption_impact(users: DataFrame, events: DataFrame, features=("notification_enabled", "favourite_location_added"), tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """A5 — per feature: adopter vs non-adopter conversion % and uplift (pp).

    The uplift is computed from the unrounded rates, then rounded (1 dp)."""
    features = list(features)
    names = features + [tax.booking_completed]
    uf = _user_flags(users, events, names).withColumnRenamed(flag_name(tax.booking_completed), "_converted")
    long = uf.unpivot(["user_id", "_converted"], [flag_name(f) for f in features], "_feature_col", "_adopted")
    conv = F.col("_converted").cast("int")
    agg = long.groupBy("_feature_col").agg(
        F.avg(F.when(F.col("_adopted") == 1, conv)).alias("_a"),
        F.avg(F.when(F.col("_adopted") == 0, conv)).alias("_n"),
    )
    a = F.lit(100.0) * F.col("_a")
    n = F.lit(100.0) * F.col("_n")
    return agg.select(
        F.regexp_replace("_feature_col", "^has_", "").alias("feature"),
        rnd(a, 1).alias("adopter_conversion_pct"),
        rnd(n, 1).alias("non_adopter_conversion_pct"),
        rnd(a - n, 1).alias("uplift_pp"),
    )
