"""Segmentation and descriptive-statistics operators (S1–S9).

Revenue is pre-aggregated per user (exact decimals, partial aggregation)
before it meets the users table, so segment totals are exact and a hot user
is collapsed before the join.  Value tiers use the distributed exact NTILE of
:mod:`cohortlab.plans.scale` instead of a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.expr import amount, div, plain, rnd, rnd_pct, shown
from cohortlab.plans.facts import retention_flags, user_bookings
from cohortlab.plans.moments import co_sums, correlation
from cohortlab.plans.scale import global_ranks, ntile_of_rank, scalars, staged, with_scalars
from cohortlab.plans.selection import selected_quantiles
from cohortlab.sources.schema import DEFAULT_TAXONOMY, Taxonomy


def _users_with_revenue(users: DataFrame, events: DataFrame, dims, tax: Taxonomy) -> DataFrame:
    return users.select("user_id", *dims).join(user_bookings(events, tax), "user_id", "left")


def segment_summary(users: DataFrame, events: DataFrame, dim: str, null_label: str | None = None, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """S1 — per ``dim``: users, converted users, conversion %, revenue, ARPU."""
    key = F.coalesce(F.col(dim), F.lit(null_label)) if null_label is not None else F.col(dim)
    agg = (
        _users_with_revenue(users, events, [dim], tax)
        .groupBy(key.alias(dim))
        .agg(
            F.count_distinct("user_id").alias("users"),
            F.count("bookings").alias("converted_users"),
            F.coalesce(F.sum("revenue"), F.lit(0).cast("decimal(38,10)")).alias("_rev"),
        )
    )
    rev = plain("_rev")
    return agg.select(
        dim,
        "users",
        "converted_users",
        rnd_pct("converted_users", "users", 1).alias("conversion_rate_pct"),
        rnd(rev, 2).alias("total_revenue_eur"),
        rnd(div(rev, "users"), 2).alias("arpu_eur"),
    )


# Tier labels of the value segmentation.
TIER_LABELS = ("Low value", "Mid value", "High value")


def value_tiers(users: DataFrame, events: DataFrame, tiles: int = 3, tax: Taxonomy = DEFAULT_TAXONOMY, labels=TIER_LABELS) -> DataFrame:
    """S2 — Non-payer / Low / Mid / High value tiers.

    Lifetime revenue per user (0 when no booking); payers (revenue > 0) are
    split into ``tiles`` equal-count tiles ordered by (revenue, user_id).  Per
    tier: users, % of users, revenue, % of total booking revenue, average.

    Events are read once, for the users with a booking; these are staged as
    narrow rows, and only the payers among them are ranked.  Everyone else is
    counted: users without a booking are all users less those found, and the
    revenue of orphan users is part of the total only.
    """
    zero = F.lit(0).cast("decimal(38,10)")
    known = users.select("user_id", F.lit(1).alias("_known"))
    spent = user_bookings(events, tax).select("user_id", F.coalesce("revenue", zero).alias("_amount"))
    spent = staged(spent.join(known, "user_id", "left"))
    ranked = global_ranks(spent.filter("_known = 1 AND _amount > 0").select("user_id", "_amount"), ["_amount", "user_id"])
    tile = ntile_of_rank("_rank", "_total", tiles)
    tier = F.lit(None).cast("string")
    for i, lbl in enumerate(labels, start=1):
        tier = F.when(tile == i, F.lit(lbl)).otherwise(tier)
    money = [F.count(F.lit(1)).alias("users"), F.sum("_amount").alias("_rev")]
    payers = ranked.groupBy(tier.alias("revenue_segment")).agg(*money)
    rest = spent.filter("_known = 1 AND _amount <= 0").groupBy(F.when(F.col("_amount") == 0, F.lit("Non-payer")).alias("revenue_segment")).agg(*money)
    totals = scalars(known.agg(F.count(F.lit(1)).alias("_users")), spent.agg(F.count("_known").alias("_found"), F.sum("_amount").alias("_all")))
    never = totals.select(F.lit("Non-payer").alias("revenue_segment"), (F.col("_users") - F.col("_found")).alias("users"), zero.alias("_rev"))
    agg = payers.unionByName(rest).unionByName(never).groupBy("revenue_segment").agg(F.sum("users").alias("users"), F.sum("_rev").alias("_rev")).filter("users > 0")
    return with_scalars(agg, totals).select(
        "revenue_segment",
        "users",
        rnd_pct("users", "_users", 1).alias("pct_of_users"),
        rnd(plain("_rev"), 2).alias("segment_revenue_eur"),
        rnd_pct("_rev", "_all", 1).alias("pct_of_total_revenue"),
        rnd(div("_rev", "users"), 2).alias("avg_revenue_per_user_eur"),
    )


def top_segments(users: DataFrame, events: DataFrame, dims=("country", "acquisition_channel"), k: int = 10, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """S3 — top ``k`` ``dims`` combinations by revenue with RANK.

    A distributed top-k (``orderBy().limit()`` → TakeOrderedAndProject) picks
    the k rows; ranks are computed on those k rows only, which equals the
    global rank because every row with a larger revenue is also in the top k.
    Ties at the k-th place are broken by the dimension values.
    """
    dims = list(dims)
    agg = (
        _users_with_revenue(users, events, dims, tax)
        .groupBy(*dims)
        .agg(F.count_distinct("user_id").alias("users"), F.coalesce(F.sum("revenue"), F.lit(0).cast("decimal(38,10)")).alias("_rev"))
    )
    top = agg.orderBy(F.col("_rev").desc(), *[F.col(d).asc() for d in dims]).limit(k)
    rev = plain("_rev")
    return top.select(
        *dims,
        "users",
        rnd(rev, 2).alias("revenue_eur"),
        rnd(div(rev, "users"), 2).alias("arpu_eur"),
        F.rank().over(Window.orderBy(F.col("_rev").desc())).cast("long").alias("revenue_rank"),
    )


def underperformers(users: DataFrame, events: DataFrame, dim: str = "acquisition_channel", tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """S4 — segments with users ≥ the mean segment size and a conversion rate
    below the unweighted mean of the (1 dp rounded) segment rates."""
    stats = (
        _users_with_revenue(users, events, [dim], tax)
        .groupBy(dim)
        .agg(F.count_distinct("user_id").alias("users"), F.count("bookings").alias("_conv"))
        .withColumn("conversion_rate_pct", rnd_pct("_conv", "users", 1))
    )
    overall = stats.agg(F.avg("users").alias("_avg_users"), F.avg("conversion_rate_pct").alias("_avg_conv"))
    return (
        with_scalars(stats, overall)
        .filter((F.col("users") >= F.col("_avg_users")) & (F.col("conversion_rate_pct") < F.col("_avg_conv")))
        .select(
            dim,
            "users",
            "conversion_rate_pct",
            rnd("_avg_conv", 1).alias("overall_avg_conversion_rate_pct"),
            rnd(F.col("conversion_rate_pct") - F.col("_avg_conv"), 1).alias("gap_vs_average_pp"),
        )
    )


def retention_risk(users: DataFrame, events: DataFrame, dim: str = "acquisition_channel", day: int = 30) -> DataFrame:
    """S5 — segments whose (1 dp) day-``day`` retention is below the (1 dp)
    user-weighted overall rate, with the gap."""
    flags = retention_flags(users, events, (day,), keep=(dim,))
    r = F.col(f"retained_day{day}").cast("int")
    per = flags.groupBy(dim).agg(F.count(F.lit(1)).alias("users"), rnd(F.lit(100.0) * F.avg(r), 1).alias(f"day{day}_retention_pct"))
    overall = flags.agg(rnd(F.lit(100.0) * F.avg(r), 1).alias(f"overall_day{day}_retention_pct"))
    mine, theirs = F.col(f"day{day}_retention_pct"), F.col(f"overall_day{day}_retention_pct")
    return (
        with_scalars(per, overall)
        .filter(mine < theirs)
        .select(dim, "users", mine, theirs, rnd(mine - theirs, 1).alias("gap_vs_average_pp"))
    )


def user_features(users: DataFrame, events: DataFrame, experiments: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY, digits: int | None = None) -> DataFrame:
    """S6 — per user: total_events, total_bookings, lifetime_revenue (0-filled),
    avg_ride_distance_km over completed bookings and days_to_conversion
    (both stay NULL when absent).  One aggregate over events.  With
    ``digits``, revenue is rounded to 2 and distance to ``digits`` decimals."""
    booking = F.col("event_name") == tax.booking_completed
    per = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_events"),
        F.count_if(booking).alias("_bookings"),
        F.sum(F.when(booking, amount("revenue"))).alias("_rev"),
        F.sum(F.when(booking, amount("ride_distance_km"))).alias("_km"),
        F.count(F.when(booking, F.col("ride_distance_km"))).alias("_rides"),
    )
    return (
        users.select("user_id")
        .join(per, "user_id", "left")
        .join(experiments.select("user_id", "days_to_conversion"), "user_id", "left")
        .select(
            "user_id",
            F.coalesce("_events", F.lit(0)).cast("long").alias("total_events"),
            F.coalesce("_bookings", F.lit(0)).cast("long").alias("total_bookings"),
            shown(F.coalesce(plain("_rev"), F.lit(0.0)), None if digits is None else 2).alias("lifetime_revenue"),
            shown(div(plain("_km"), "_rides"), digits).alias("avg_ride_distance_km"),
            F.col("days_to_conversion").cast("long").alias("days_to_conversion"),
        )
    )


FEATURE_COLUMNS = ("total_events", "total_bookings", "lifetime_revenue", "avg_ride_distance_km", "days_to_conversion")


def corr_matrix(df: DataFrame, cols=FEATURE_COLUMNS, digits: int | None = None) -> DataFrame:
    """S7 — pairwise-complete Pearson correlations as a long table
    (feature_x, feature_y, correlation); one aggregate computes every pair
    from exact sums, so the result is the same however the rows are dealt."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[c for a, b in pairs for c in co_sums(a, b, f"{a}__{b}__")])
    row = row.select(*[correlation(f"{a}__{b}__").alias(f"{a}__{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        cells.append(F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), F.col(f"{a}__{b}").alias("c")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("feature_x"), F.lit(a).alias("feature_y"), F.col(f"{a}__{b}").alias("c")))
    return row.select(F.inline(F.array(*cells))).select("feature_x", "feature_y", shown(F.col("c"), digits).alias("correlation"))


def describe(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    """S8 — count, mean, std (sample), min, quartiles (linear interpolation),
    max per numeric column, nulls dropped.

    Columns are unpivoted to (column, value).  Moments come from one partial
    aggregate; the quartiles from :func:`selected_quantiles`, which narrows
    each rank down by histograms: no value is sorted, shuffled or stored."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value").filter(
        F.col("value").isNotNull()
    )
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("_mean"),
        F.stddev_samp("value").alias("_std"),
        F.min("value").alias("_min"),
        F.max("value").alias("_max"),
    )
    quarts = selected_quantiles(long, "value", [0.25, 0.5, 0.75], ["column"])
    return moments.join(quarts, "column").select(
        "column",
        "count",
        rnd("_mean", digits).alias("mean"),
        rnd("_std", digits).alias("std"),
        rnd("_min", digits).alias("min"),
        rnd("q0", digits).alias("p25"),
        rnd("q1", digits).alias("p50"),
        rnd("q2", digits).alias("p75"),
        rnd("_max", digits).alias("max"),
    )


def histogram(df: DataFrame, col: str, bins: int = 30, digits: int = 6) -> DataFrame:
    """S9 — equal-width histogram of ``col`` (nulls dropped) with ``bins`` bins
    between its min and max; the last bin is closed.  A constant column gets
    the range of half a unit to both sides.  Bins are decided by their edges
    ``lo + i * width``: the quotient only proposes a bin, which is moved by
    one where rounding put the value beyond an edge.  Zero-filled over a
    ``range(bins)`` spine."""
    x = F.col(col).cast("double")
    vals = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    half = F.when(F.min("_x") == F.max("_x"), 0.5).otherwise(0.0)
    bounds = vals.agg((F.min("_x") - half).alias("_lo"), (F.max("_x") + half).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / float(bins)

    def edge(i):
        return F.col("_lo") + i * width

    guess = F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1)).cast("long")
    placed = with_scalars(vals, bounds).withColumn("_g", guess)
    g = F.col("_g")
    idx = F.when(F.col("_x") < edge(g), g - 1).when((g < bins - 1) & (F.col("_x") >= edge(g + 1)), g + 1).otherwise(g)
    counts = placed.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    spine = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    grid = with_scalars(spine, bounds).join(counts, "bin", "left")
    return grid.select(
        F.lit(col).alias("column"),
        "bin",
        rnd(edge(F.col("bin")), digits).alias("bin_lo"),
        rnd(edge(F.col("bin") + 1), digits).alias("bin_hi"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("count"),
    )
