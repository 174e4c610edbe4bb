"""Overview and KPI operators (K1–K22).

Patterns used throughout:

* per-user pre-aggregation of events before any join with users, so a hot
  user is collapsed map-side and the join sees one row per user;
* distinct counts as two hash aggregates (entity-level dedupe, then count)
  instead of mixing DISTINCT and non-DISTINCT aggregates (which would Expand);
* scalar totals as one-row aggregates attached by broadcast
  (:func:`cohortlab.plans.scale.with_scalars`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import amount, day_offset, div, flag, plain, month_key, pct, rnd, rnd_div, rnd_pct, week_key
from cohortlab.plans.facts import flag_name, is_user_day_facts, user_bookings, user_day_facts
from cohortlab.plans.scale import scalars, with_scalars
from cohortlab.sources.schema import ACTIVATION_WINDOW_DAYS, CHURN_INACTIVITY_DAYS, DEFAULT_TAXONOMY, Taxonomy


def _total_users(users: DataFrame, alias: str = "total_users") -> DataFrame:
    return users.agg(F.count(F.lit(1)).alias(alias))


def headline(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K1 — one row: users, bookings, revenue and the covered date range."""
    booking = F.col("event_name") == tax.booking_completed
    u = users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.min("signup_date").alias("first_signup"),
        F.max("signup_date").alias("last_signup"),
    )
    e = events.agg(
        F.count_if(booking).alias("total_bookings"),
        F.sum(F.when(booking, amount("revenue"))).alias("_rev"),
        F.min("event_date").alias("first_event"),
        F.max("event_date").alias("last_event"),
    )
    return scalars(u, e).select(
        "total_users",
        "total_bookings",
        rnd(plain("_rev"), 2).alias("total_revenue_eur"),
        "first_signup",
        "last_signup",
        "first_event",
        "last_event",
    )


def composition(
    df: DataFrame,
    dim: str,
    null_label: str | None = None,
    count_name: str = "user_count",
    pct_name: str = "pct_of_users",
    digits: int = 1,
) -> DataFrame:
    """K2/K3/K6 — rows per value of ``dim`` with count and share of all rows.

    The total is summed from the grouped counts, so the table is scanned once.
    """
    key = F.coalesce(F.col(dim), F.lit(null_label)) if null_label is not None else F.col(dim)
    counts = df.groupBy(key.alias(dim)).agg(F.count(F.lit(1)).alias(count_name))
    total = counts.agg(F.sum(count_name).alias("_total"))
    return with_scalars(counts, total).select(dim, count_name, rnd(pct(count_name, "_total"), digits).alias(pct_name))


def signup_trend(users: DataFrame) -> DataFrame:
    """K4 / C1 — new users per signup month."""
    return users.groupBy(month_key("signup_date").alias("signup_month")).agg(F.count(F.lit(1)).alias("new_users"))


def booking_trend(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K5 — completed bookings, revenue and average booking value per month."""
    b = events.filter(F.col("event_name") == tax.booking_completed)
    agg = b.groupBy(month_key("event_date").alias("month")).agg(
        F.count(F.lit(1)).alias("completed_bookings"),
        F.sum(amount("revenue")).alias("_rev"),
        F.count("revenue").alias("_n"),
    )
    return agg.select(
        "month",
        "completed_bookings",
        rnd(plain("_rev"), 2).alias("revenue_eur"),
        rnd(div(plain("_rev"), "_n"), 2).alias("avg_booking_value_eur"),
    )


def ever_active(users: DataFrame, events: DataFrame) -> DataFrame:
    """K7 — total users, users with ≥1 event, and their share."""
    active = events.select("user_id").distinct().agg(F.count(F.lit(1)).alias("ever_active_users"))
    return scalars(_total_users(users), active).select(
        "total_users", "ever_active_users", rnd_pct("ever_active_users", "total_users", 1).alias("pct_ever_active")
    )


def active_users(events: DataFrame, grain: str = "day", approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """K8/K9/K10 — distinct active users per day, Monday-week or month.

    Exact mode deduplicates (period, user) with a first aggregate and counts
    with a second, so no DISTINCT aggregate is mixed with others.  With
    ``approx`` the count is a HyperLogLog++ sketch (``approx_count_distinct``,
    relative standard deviation ``rsd``): one partial aggregate whose state
    per period is a few KB no matter how many users are active.
    """
    keys = {
        "day": [F.col("event_date")],
        "week_mon": [week_key("event_date").alias("iso_week")],
        "month": [month_key("event_date").alias("month")],
    }
    if grain not in keys:
        raise ValueError(f"unknown grain {grain!r}")
    out = {"day": "dau", "week_mon": "wau", "month": "mau"}[grain]
    if approx:
        extra = [F.min("event_date").alias("week_start_sample")] if grain == "week_mon" else []
        return events.groupBy(*keys[grain]).agg(*extra, F.approx_count_distinct("user_id", rsd).alias(out))
    if grain == "day":
        return events.groupBy("event_date").agg(F.count_distinct("user_id").alias("dau"))
    if grain == "week_mon":
        per = events.groupBy(week_key("event_date").alias("iso_week"), "user_id").agg(F.min("event_date").alias("_d"))
        return per.groupBy("iso_week").agg(F.min("_d").alias("week_start_sample"), F.count(F.lit(1)).alias("wau"))
    per = events.select(month_key("event_date").alias("month"), "user_id").distinct()
    return per.groupBy("month").agg(F.count(F.lit(1)).alias("mau"))


def stickiness(events: DataFrame) -> DataFrame:
    """K11 — per month: mean DAU over days with events, MAU, and mean DAU / MAU.

    One pass: a user's active days of a month are the bits of one number."""
    day = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth("event_date"))
    masks = events.groupBy(month_key("event_date").alias("month"), "user_id").agg(F.bit_or(day).alias("_days"))
    per = masks.groupBy("month").agg(
        F.sum(F.bit_count("_days")).alias("_user_days"), F.bit_count(F.bit_or("_days")).alias("_n_days"), F.count(F.lit(1)).alias("mau")
    )
    return per.withColumn("_avg_dau", div("_user_days", "_n_days")).select(
        "month",
        rnd("_avg_dau", 1).alias("avg_dau"),
        "mau",
        rnd_pct("_avg_dau", "mau", 1).alias("stickiness_pct"),
    )


def activated_users(users: DataFrame, events: DataFrame, window: int = ACTIVATION_WINDOW_DAYS, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """Users with both a search_completed and a booking_completed whose day
    offset from signup is within [0, window].  Events are first reduced to
    (user, date) flags so the join with users sees one row per active day
    (``events`` may already be the table of :func:`user_day_facts`)."""
    s_col, b_col = flag_name(tax.search_completed), flag_name(tax.booking_completed)
    if is_user_day_facts(events):
        per_day = events.select("user_id", "event_date", F.col(s_col).alias("_s"), F.col(b_col).alias("_b"))
    else:
        name = F.col("event_name")
        per_day = (
            events.filter(name.isin(tax.search_completed, tax.booking_completed))
            .groupBy("user_id", "event_date")
            .agg(F.max(flag(name == tax.search_completed)).alias("_s"), F.max(flag(name == tax.booking_completed)).alias("_b"))
        )
    joined = per_day.join(users.select("user_id", "signup_date"), "user_id").filter(
        day_offset("event_date", "signup_date").between(0, window)
    )
    per_user = joined.groupBy("user_id").agg(F.max("_s").alias("_s"), F.max("_b").alias("_b"))
    return per_user.filter((F.col("_s") == 1) & (F.col("_b") == 1)).select("user_id")


def activation(users: DataFrame, events: DataFrame, window: int = ACTIVATION_WINDOW_DAYS, tax: Taxonomy = DEFAULT_TAXONOMY, digits: int = 2) -> DataFrame:
    """K12 — total_users, activated_users, activation_rate_pct."""
    act = activated_users(users, events, window, tax).agg(F.count(F.lit(1)).alias("activated_users"))
    return scalars(_total_users(users), act).select(
        "total_users", "activated_users", rnd(pct("activated_users", "total_users"), digits).alias("activation_rate_pct")
    )


def _converted_count(events: DataFrame, tax: Taxonomy, alias: str = "converted_users") -> DataFrame:
    return user_bookings(events, tax).agg(F.count(F.lit(1)).alias(alias))


def conversion(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K13 — total_users, converted_users, conversion_rate_pct (2 dp)."""
    return scalars(_total_users(users), _converted_count(events, tax)).select(
        "total_users", "converted_users", rnd_pct("converted_users", "total_users", 2).alias("conversion_rate_pct")
    )


def _booking_totals(events: DataFrame, tax: Taxonomy) -> DataFrame:
    """One row: bookings, revenue, revenue rows, paying users."""
    return user_bookings(events, tax).agg(
        F.coalesce(F.sum("bookings"), F.lit(0)).cast("long").alias("_bookings"),
        F.sum("revenue").alias("_rev"),
        F.coalesce(F.sum("revenue_rows"), F.lit(0)).cast("long").alias("_rev_rows"),
        F.count(F.lit(1)).alias("_payers"),
    )


def revenue_kpis(users: DataFrame, events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K14 — total revenue, ARPU, ARPPU, AOV, bookings per user / per payer."""
    row = scalars(_total_users(users, "_users"), _booking_totals(events, tax))
    rev = plain("_rev")
    return row.select(
        rnd(rev, 2).alias("total_revenue_eur"),
        rnd(div(rev, "_users"), 2).alias("arpu_eur"),
        rnd(div(rev, "_payers"), 2).alias("arppu_eur"),
        rnd(div(rev, "_rev_rows"), 2).alias("avg_booking_value_eur"),
        rnd_div("_bookings", "_users", 2).alias("bookings_per_user_overall"),
        rnd_div("_bookings", "_payers", 2).alias("bookings_per_paying_user"),
    )


def revenue_by(users: DataFrame, events: DataFrame, dim: str, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K15 — per ``dim``: completed bookings, revenue (NULL if none), ARPU over
    all users of the segment, average booking value."""
    per_user = user_bookings(events, tax)
    agg = (
        users.select("user_id", dim)
        .join(per_user, "user_id", "left")
        .groupBy(dim)
        .agg(
            F.coalesce(F.sum("booking_ids"), F.lit(0)).cast("long").alias("completed_bookings"),
            F.sum("revenue").alias("_rev"),
            F.sum("revenue_rows").alias("_rows"),
            F.count_distinct("user_id").alias("_users"),
        )
    )
    rev = plain("_rev")
    return agg.select(
        dim,
        "completed_bookings",
        rnd(rev, 2).alias("revenue_eur"),
        rnd(div(rev, "_users"), 2).alias("arpu_eur"),
        rnd(div(rev, "_rows"), 2).alias("avg_booking_value_eur"),
    )


def _executive_row(users: DataFrame, events: DataFrame, window: int, tax: Taxonomy, day: int | None = None) -> DataFrame:
    """One row with every executive figure, from a single linear plan:

    events → (user, day) facts → ⟕ users → per-user flags → rows per last
    activity date → one global row.  Events are scanned once; the
    per-last-date frame has at most one row per calendar day, and the final
    row keeps that (date, users) histogram so churn for any inactivity
    threshold is read off it without another pass.
    """
    facts = user_day_facts(events, tax)
    joined = facts.join(users.select("user_id", "signup_date"), "user_id", "left")
    off = day_offset("event_date", "signup_date")
    in_window = off.between(0, window)
    per_user = joined.groupBy("user_id").agg(
        F.max(flag_name(tax.booking_completed)).alias("_paid"),
        F.sum("revenue").alias("_amount"),
        F.sum("revenue_rows").alias("_rows"),
        F.max(F.when(in_window, F.col(flag_name(tax.search_completed)))).alias("_s"),
        F.max(F.when(in_window, F.col(flag_name(tax.booking_completed)))).alias("_b"),
        (F.max(flag(off == day)) if day is not None else F.lit(0)).alias("_ret"),
        F.max("event_date").alias("_last"),
    )
    by_last = per_user.groupBy("_last").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_paid").alias("_paid"),
        F.sum(F.when(F.col("_paid") == 1, F.col("_amount"))).alias("_amount"),
        F.sum("_rows").alias("_rows"),
        F.count_if((F.col("_s") == 1) & (F.col("_b") == 1)).alias("_act"),
        F.sum("_ret").alias("_ret"),
    )
    return by_last.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("_active"),
        F.coalesce(F.sum("_paid"), F.lit(0)).cast("long").alias("_payers"),
        F.sum("_amount").alias("_rev"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("_rev_rows"),
        F.coalesce(F.sum("_act"), F.lit(0)).cast("long").alias("_activated"),
        F.coalesce(F.sum("_ret"), F.lit(0)).cast("long").alias("_ret"),
        F.max("_last").alias("_end"),
        F.collect_list(F.struct(F.col("_last").alias("d"), F.col("_n").alias("n"))).alias("_by_last"),
    )


def _churned(inactive: int):
    """Users whose last activity is ≥ ``inactive`` days before the last date,
    read from the per-last-date histogram of :func:`_executive_row`."""
    late = F.filter("_by_last", lambda x: F.datediff(F.col("_end"), x["d"]) >= inactive)
    return F.aggregate(late, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])


def exec_kpis(users: DataFrame, events: DataFrame, window: int = ACTIVATION_WINDOW_DAYS, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K16 — single-row executive KPI summary (9 columns)."""
    row = scalars(_total_users(users), _executive_row(users, events, window, tax))
    rev = plain("_rev")
    return row.select(
        "total_users",
        F.col("_active").alias("active_users"),
        F.col("_activated").alias("activated_users"),
        rnd_pct("_activated", "total_users", 2).alias("activation_rate_pct"),
        F.col("_payers").alias("converted_users"),
        rnd_pct("_payers", "total_users", 2).alias("conversion_rate_pct"),
        rnd(rev, 2).alias("total_revenue_eur"),
        rnd(div(rev, "total_users"), 2).alias("arpu_eur"),
        rnd(div(rev, "_rev_rows"), 2).alias("avg_booking_value_eur"),
    )


def exec_kpis_churn(users: DataFrame, events: DataFrame, window: int = ACTIVATION_WINDOW_DAYS, inactive: int = CHURN_INACTIVITY_DAYS, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K17 — executive row with churn; the churn denominator is *active* users."""
    row = scalars(_total_users(users), _executive_row(users, events, window, tax)).withColumn("_churned", _churned(inactive))
    rev = plain("_rev")
    return row.select(
        "total_users",
        rnd_pct("_activated", "total_users", 1).alias("activation_rate_pct"),
        rnd_pct("_payers", "total_users", 1).alias("conversion_rate_pct"),
        rnd(rev, 0).alias("total_revenue_eur"),
        rnd(div(rev, "total_users"), 2).alias("arpu_eur"),
        rnd_pct("_churned", "_active", 1).alias("churn_rate_pct"),
    )


def kpi_tiles(users: DataFrame, events: DataFrame, day: int = 30, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K18 — the six headline tiles: users, revenue (0 dp), ARPU, conversion %
    (1 dp), day-``day`` retention % (1 dp), average booking value."""
    row = scalars(_total_users(users), _executive_row(users, events, ACTIVATION_WINDOW_DAYS, tax, day=day))
    rev = plain("_rev")
    return row.select(
        "total_users",
        rnd(rev, 0).alias("total_revenue_eur"),
        rnd(div(rev, "total_users"), 2).alias("arpu_eur"),
        rnd_pct("_payers", "total_users", 1).alias("conversion_rate_pct"),
        rnd_pct("_ret", "total_users", 1).alias(f"day{day}_retention_pct"),
        rnd(div(rev, "_rev_rows"), 2).alias("avg_booking_value_eur"),
    )


def conversion_by(users: DataFrame, events: DataFrame, dim: str, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K19 — conversion % per ``dim`` value with best / worst markers.

    Best / worst come from ``max_by`` / ``min_by`` over the per-segment rows
    (ties: the larger / smaller segment value wins)."""
    payers = user_bookings(events, tax).select("user_id").withColumn("_c", F.lit(1))
    per = (
        users.select("user_id", dim)
        .join(payers, "user_id", "left")
        .groupBy(dim)
        .agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("converted_users"))
        .withColumn("conversion_rate_pct", rnd_pct("converted_users", "users", 2))
    )
    ext = per.agg(
        F.max_by(F.col(dim), F.struct("conversion_rate_pct", F.col(dim))).alias("_best"),
        F.min_by(F.col(dim), F.struct("conversion_rate_pct", F.col(dim))).alias("_worst"),
    )
    return with_scalars(per, ext).select(
        dim,
        "users",
        "converted_users",
        "conversion_rate_pct",
        (F.col(dim) == F.col("_best")).alias("is_best"),
        (F.col(dim) == F.col("_worst")).alias("is_worst"),
    )


def mismatch_rate(users: DataFrame, a: str = "platform", b: str = "first_device_type") -> DataFrame:
    """K20 — share of users whose ``a`` differs from ``b`` (2 dp)."""
    return users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.col(a) != F.col(b)).alias("mismatched_users"),
    ).select("total_users", "mismatched_users", rnd_pct("mismatched_users", "total_users", 2).alias("mismatch_pct"))


def crosstab(users: DataFrame, row: str, column: str, values=None, labels=None, normalize: bool = False, max_values: int = 1000) -> DataFrame:
    """K21/K22 — cross-tab counts of ``row`` × ``column`` (+ total); with
    ``normalize`` the cells are the row-normalised percentage (2 dp) over all
    of the row's users.

    ``values`` lists the columns of a fixed report (K21).  By default there is
    a column for every value present, nulls as ``null``; more than
    ``max_values`` of them are an error, not a cut."""
    if values is None:
        found = users.select(column).distinct().limit(max_values + 1).collect()
        if len(found) > max_values:
            raise ValueError(f"{column} has more than {max_values} values")
        values = sorted((r[0] for r in found), key=lambda v: (v is None, str(v)))
    labels = labels or [f"{'null' if v is None else str(v).lower()}_users" for v in values]
    cells = [F.sum(flag(F.col(column).eqNullSafe(F.lit(v)))).cast("long").alias(lbl) for v, lbl in zip(values, labels)]
    out = users.groupBy(row).agg(*cells, F.count(F.lit(1)).alias("total_users"))
    if normalize:
        return out.select(row, *[rnd(pct(lbl, "total_users"), 2).alias(lbl.replace("_users", "_pct")) for lbl in labels], "total_users")
    return out
