"""Retention, churn and cohort operators (T0–T4, C1–C4).

Day-N retention: a user is retained on day N when they have ≥1 event on the
calendar date exactly N days after signup; the denominator is all users,
never-active ones included.  All operators start from distinct (user, date)
activity, so the join with users sees at most one row per active day and a
user holding many events is collapsed map-side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.expr import amount, plain, month_index, month_key, pct, rnd, rnd_pct
from cohortlab.plans.activity import active_months, bits_from, is_activity_bitmap, months_of
from cohortlab.plans.facts import retention_flags, user_activity, user_offsets
from cohortlab.plans.scale import with_scalars
from cohortlab.sources.schema import CHURN_INACTIVITY_DAYS, DEFAULT_TAXONOMY, RETENTION_CHECKPOINTS_DAYS, Taxonomy


def compute_retention_flags(users: DataFrame, events: DataFrame, days=RETENTION_CHECKPOINTS_DAYS) -> DataFrame:
    """T0 — user_id, retained_day<N>… (0/1)."""
    return retention_flags(users, events, days)


def retention(users: DataFrame, events: DataFrame, days=RETENTION_CHECKPOINTS_DAYS) -> DataFrame:
    """T1 — total users, retained users and % (1 dp) per checkpoint, one row."""
    flags = retention_flags(users, events, days)
    agg = flags.agg(
        F.count(F.lit(1)).alias("total_users"),
        *[F.coalesce(F.sum(f"retained_day{d}"), F.lit(0)).cast("long").alias(f"day{d}_retained_users") for d in days],
    )
    cols = ["total_users"]
    for d in days:
        cols += [f"day{d}_retained_users", rnd(pct(f"day{d}_retained_users", "total_users"), 1).alias(f"day{d}_retention_pct")]
    return agg.select(*cols)


def retention_by(users: DataFrame, events: DataFrame, dim: str, days=RETENTION_CHECKPOINTS_DAYS) -> DataFrame:
    """T2 — per ``dim``: total users and % retained per checkpoint (1 dp)."""
    flags = retention_flags(users, events, days, keep=(dim,))
    agg = flags.groupBy(dim).agg(
        F.count(F.lit(1)).alias("total_users"), *[F.sum(f"retained_day{d}").alias(f"_r{d}") for d in days]
    )
    return agg.select(
        dim, "total_users", *[rnd(pct(f"_r{d}", "total_users"), 1).alias(f"day{d}_retention_pct") for d in days]
    )


def retention_curve(users: DataFrame, events: DataFrame, max_day: int = 60, digits: int = 4) -> DataFrame:
    """T3 — % of all users active on each exact day offset 0..max_day (zero-filled).

    The spine is ``range(0, max_day + 1)`` (size fixed by the parameter), left
    joined to the per-offset distinct-user counts.
    """
    spark = users.sparkSession
    if is_activity_bitmap(events):
        return _curve_of_bitmaps(users, events, max_day, digits)
    offs = user_offsets(users, events).filter(F.col("days_since_signup").between(0, max_day))
    per_day = offs.distinct().groupBy("days_since_signup").agg(F.count(F.lit(1)).alias("active_users"))
    spine = spark.range(0, max_day + 1).select(F.col("id").alias("days_since_signup"))
    total = users.agg(F.count(F.lit(1)).alias("_total"))
    curve = spine.join(per_day, "days_since_signup", "left").select(
        "days_since_signup", F.coalesce("active_users", F.lit(0)).cast("long").alias("active_users")
    )
    return with_scalars(curve, total).select(
        "days_since_signup", "active_users", rnd(pct("active_users", "_total"), digits).alias("pct_of_users")
    )


def _curve_of_bitmaps(users: DataFrame, bitmap: DataFrame, max_day: int, digits: int) -> DataFrame:
    """The curve as one global aggregate: the days from signup on are cut out
    of the user's bitmap, 64 to a number, and each bit is counted."""
    own = users.select("user_id", "signup_date").join(bitmap.select("user_id", "base", "words"), "user_id", "left")
    signup = F.datediff("signup_date", F.col("base"))
    own = own.select(*[bits_from(signup + first).alias(f"_w{first // 64}") for first in range(0, max_day + 1, 64)])
    bit = lambda d: F.lit((1 << d % 64) - ((1 << 64) if d % 64 == 63 else 0)).cast("long")
    row = own.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(f"_w{d // 64}").bitwiseAND(bit(d)) != 0).alias(f"_{d}") for d in range(max_day + 1)])
    cells = [F.struct(F.lit(d).cast("long").alias("days_since_signup"), F.col(f"_{d}").alias("active_users")) for d in range(max_day + 1)]
    return row.select("_total", F.inline(F.array(*cells))).select("days_since_signup", "active_users", rnd(pct("active_users", "_total"), digits).alias("pct_of_users"))


def churn(users: DataFrame, events: DataFrame, inactive: int = CHURN_INACTIVITY_DAYS) -> DataFrame:
    """T4 — total users, churned users (last event ≥ ``inactive`` days before the
    dataset's last event date) and rate; denominator is all users and
    never-active users do not count as churned.

    One events scan, one linear plan: per-user last dates ⟗ users, counted
    per (last date, known user) — at most two rows per calendar day — and the
    dataset's last date and the churned count are read off that histogram
    (orphan users' dates still move the dataset's last date)."""
    last = user_activity(events).select("user_id", "last_event_date")
    known = users.select("user_id").withColumn("_u", F.lit(1))
    hist = last.join(known, "user_id", "full_outer").groupBy("last_event_date", "_u").agg(F.count(F.lit(1)).alias("_n"))
    row = hist.agg(
        F.coalesce(F.sum(F.when(F.col("_u") == 1, F.col("_n"))), F.lit(0)).cast("long").alias("total_users"),
        F.max("last_event_date").alias("_end"),
        F.collect_list(F.struct(F.col("last_event_date").alias("d"), F.col("_u").alias("u"), F.col("_n").alias("n"))).alias("_h"),
    )
    churned = F.aggregate(
        F.filter("_h", lambda x: (x["u"] == 1) & (F.datediff(F.col("_end"), x["d"]) >= inactive)),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x["n"],
    )
    return row.select("total_users", churned.alias("churned_users")).select(
        "total_users", "churned_users", rnd_pct("churned_users", "total_users", 1).alias("churn_rate_pct")
    )


def _cohorts(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        month_key("signup_date").alias("cohort_month"),
        month_index("signup_date").alias("cohort_month_index"),
    )


def cohort_sizes(users: DataFrame) -> DataFrame:
    """C1 — cohort_month, cohort_size."""
    return _cohorts(users).groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))


def cohort_retention(users: DataFrame, events: DataFrame) -> DataFrame:
    """C2 — long-form cohort table: cohort_month, months_since_signup,
    cohort_size, retained_users, retention_pct (sparse; offsets ≥ 0)."""
    if is_activity_bitmap(events):
        activity = events.select("user_id", F.explode(active_months(*months_of(events))).alias("event_month_index"))
    else:
        activity = events.select("user_id", month_index("event_date").alias("event_month_index")).distinct()
    cohorts = _cohorts(users)
    sizes = cohort_sizes(users)
    cohort_activity = (
        cohorts.join(activity, "user_id")
        .filter(F.col("event_month_index") >= F.col("cohort_month_index"))
        .select("cohort_month", "user_id", (F.col("event_month_index") - F.col("cohort_month_index")).alias("months_since_signup"))
    )
    # a bitmap has one row per user and month by construction: nothing to deduplicate
    users_in = F.count(F.lit(1)) if is_activity_bitmap(events) else F.count_distinct("user_id")
    retained = cohort_activity.groupBy("cohort_month", "months_since_signup").agg(users_in.alias("retained_users"))
    return retained.join(sizes, "cohort_month").select(
        "cohort_month",
        "months_since_signup",
        "cohort_size",
        "retained_users",
        rnd_pct("retained_users", "cohort_size", 1).alias("retention_pct"),
    )


def cohort_matrix(users: DataFrame, events: DataFrame, mask: bool = True, digits: int = 2) -> DataFrame:
    """C3 — dense cohort × offset retention % (long form: one row per cell).

    Cells from offset 0 to the last offset any cohort reaches are zero-filled;
    with ``mask`` a cell later than the dataset's last event month is NULL
    (not yet observable).  Events are read once: distinct (user, month) pairs
    give, per cohort, a map from offset to returning users, the largest offset
    and the last month (orphan users count for the last month only).  Cohorts
    are months, so the map and the window over cohorts are small.
    """
    activity = events.select("user_id", month_index("event_date").alias("_m")).distinct()
    cohorts = _cohorts(users)
    born = F.col("cohort_month_index")
    per = activity.join(cohorts, "user_id", "left").groupBy("cohort_month", born, "_m").agg(F.count_distinct("user_id").alias("_n"))
    seen = (F.col("_m") >= born)
    per = per.groupBy("cohort_month").agg(
        F.map_from_entries(F.collect_list(F.when(seen, F.struct((F.col("_m") - born).alias("k"), "_n")))).alias("_back"),
        F.max(F.when(seen, F.col("_m") - born)).alias("_reach"),
        F.max("_m").alias("_last"),
    )
    sizes = cohorts.groupBy("cohort_month", born).agg(F.count(F.lit(1)).alias("cohort_size"))
    whole = Window.partitionBy(F.lit(1))
    table = sizes.join(per, "cohort_month", "full").withColumns({"_reach": F.max("_reach").over(whole), "_last": F.max("_last").over(whole)})
    cells = table.filter("cohort_size is not null and _reach is not null").select("*", F.explode(F.sequence(F.lit(0).cast("long"), "_reach")).alias("months_since_signup"))
    value = rnd(pct(F.coalesce(F.try_element_at("_back", F.col("months_since_signup")), F.lit(0)), "cohort_size"), digits)
    observable = F.col("months_since_signup") <= F.col("_last") - born
    return cells.select("cohort_month", "months_since_signup", (F.when(observable, value) if mask else value).alias("retention_pct"))


def cohort_revenue(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """C4 — revenue per cohort and months since signup, and per cohort user."""
    # revenue per (user, month) first: a user owning many bookings reaches
    # the join as one row per active month
    bookings = (
        events.filter(F.col("event_name") == tax.booking_completed)
        .groupBy("user_id", month_index("event_date").alias("event_month_index"))
        .agg(F.sum(amount("revenue")).alias("_c"))
    )
    cohorts = _cohorts(users)
    sizes = cohort_sizes(users)
    rev = (
        cohorts.join(bookings, "user_id")
        .filter(F.col("event_month_index") >= F.col("cohort_month_index"))
        .groupBy("cohort_month", (F.col("event_month_index") - F.col("cohort_month_index")).alias("months_since_signup"))
        .agg(F.sum("_c").alias("_rev"))
    )
    money = plain("_rev")
    return rev.join(sizes, "cohort_month").select(
        "cohort_month",
        "months_since_signup",
        "cohort_size",
        rnd(money, 2).alias("revenue_eur"),
        rnd(money / F.col("cohort_size"), 2).alias("revenue_per_cohort_user_eur"),
    )


def cohort_revenue_cumulative(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """C4 — revenue of each cohort month by month and its running sum, also per
    cohort user, on a dense cohort × offset spine.

    The spine goes from offset 0 to the one that the oldest cohort has reached
    in the last month with an event.  A month without bookings adds nothing
    and carries the sum on; a cell later than the last month is not yet
    observable: revenue and sums are NULL.  Events are read once; cohorts and
    offsets are months, so the window runs over a few hundred rows at most."""
    booking = F.col("event_name") == tax.booking_completed
    monthly = events.groupBy("user_id", month_index("event_date").alias("_m")).agg(F.sum(F.when(booking, amount("revenue"))).alias("_c"))
    cohorts = _cohorts(users)
    born, zero = F.col("cohort_month_index"), F.lit(0).cast("decimal(38,10)")
    per = monthly.join(cohorts, "user_id", "left").groupBy("cohort_month", born, "_m").agg(F.sum("_c").alias("_c"))
    spent = F.struct((F.col("_m") - born).alias("k"), F.coalesce("_c", zero).alias("c"))
    per = per.groupBy("cohort_month").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("_m") >= born, spent))).alias("_spent"), F.max("_m").alias("_last")
    )
    sizes = cohorts.groupBy("cohort_month", born).agg(F.count(F.lit(1)).alias("cohort_size"))
    whole = Window.partitionBy(F.lit(1))
    table = sizes.join(per, "cohort_month", "full").withColumns({"_last": F.max("_last").over(whole), "_first": F.min("cohort_month_index").over(whole)})
    table = table.filter(F.col("cohort_size").isNotNull() & (F.col("_last") >= F.col("_first")))
    cells = table.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last") - F.col("_first"))).alias("months_since_signup"))
    seen = F.col("months_since_signup") <= F.col("_last") - born
    cells = cells.withColumn("_rev", F.when(seen, F.coalesce(F.try_element_at("_spent", F.col("months_since_signup")), zero)))
    until = Window.partitionBy("cohort_month").orderBy("months_since_signup").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = plain(F.when(seen, F.sum("_rev").over(until)))
    return cells.select(
        "cohort_month", "months_since_signup", "cohort_size", rnd(plain("_rev"), 2).alias("revenue_eur"),
        rnd(total, 2).alias("cumulative_revenue_eur"), rnd(total / F.col("cohort_size"), 2).alias("cumulative_per_cohort_user_eur"),
    )
