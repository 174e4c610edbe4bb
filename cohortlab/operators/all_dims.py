"""Families of per-dimension tables from one pass (K2/K3, K15, T2, S1).

The reference tables ask the same figures once per dimension.  Here the
figures of each user are made once and added up per combination of all
dimensions, in one aggregate that reads each table once; what is left has at
most one row per combination, and is added up again per (dimension, value).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import div, flag, pct, plain, rnd, rnd_pct
from cohortlab.plans.facts import retention_flags, user_bookings
from cohortlab.plans.scale import with_scalars
from cohortlab.sources.schema import DEFAULT_TAXONOMY, RETENTION_CHECKPOINTS_DAYS, Taxonomy

#: Dimensions of users with the label of their missing values (None: a null row).
SEGMENT_DIMS = {"country": None, "platform": None, "age_group": "Unspecified", "acquisition_channel": None}


def per_value(people: DataFrame, dims: Mapping[str, str | None], sums: Mapping[str, F.Column]) -> DataFrame:
    """(dim, value, figures): ``sums`` (figure -> column of ``people``) added
    up for every value of every dimension.  ``people`` is read once."""
    inside = people.groupBy(*[F.col(d).cast("string").alias(f"_d{i}") for i, d in enumerate(dims)]).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    values = [F.coalesce(F.col(f"_d{i}"), F.lit(label)) if label is not None else F.col(f"_d{i}") for i, label in enumerate(dims.values())]
    cells = F.array(*[F.struct(F.lit(d).alias("dim"), v.alias("value")) for d, v in zip(dims, values)])
    rows = inside.select(F.inline(cells), *sums)
    return rows.groupBy("dim", "value").agg(*[F.sum(n).alias(n) for n in sums])


def composition_by_all(users: DataFrame, dims: Mapping[str, str | None] = SEGMENT_DIMS, digits: int = 1) -> DataFrame:
    """K2/K3 — dim, value, user_count and share of all users."""
    counts = per_value(users, dims, {"user_count": F.lit(1).cast("long")})
    total = counts.filter(F.col("dim") == next(iter(dims))).agg(F.sum("user_count").alias("_total"))
    return with_scalars(counts, total).select("dim", "value", "user_count", rnd(pct("user_count", "_total"), digits).alias("pct_of_users"))


def _spenders(users: DataFrame, events: DataFrame, dims, tax: Taxonomy) -> DataFrame:
    return users.select("user_id", *dims).join(user_bookings(events, tax), "user_id", "left")


def revenue_by_all(users: DataFrame, events: DataFrame, dims: Mapping[str, str | None] = SEGMENT_DIMS, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """K15 — dim, value, completed bookings, revenue (null if none), ARPU over
    all users of the segment, average booking value."""
    figures = {"_users": F.lit(1).cast("long"), "_ids": F.col("booking_ids"), "_rev": F.col("revenue"), "_rows": F.col("revenue_rows")}
    agg = per_value(_spenders(users, events, dims, tax), dims, figures)
    money = plain("_rev")
    return agg.select(
        "dim", "value", F.coalesce("_ids", F.lit(0)).cast("long").alias("completed_bookings"),
        rnd(money, 2).alias("revenue_eur"), rnd(div(money, "_users"), 2).alias("arpu_eur"), rnd(div(money, "_rows"), 2).alias("avg_booking_value_eur"),
    )


def segment_summary_all(users: DataFrame, events: DataFrame, dims: Mapping[str, str | None] = SEGMENT_DIMS, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """S1 — dim, value, users, converted users, conversion %, revenue, ARPU."""
    paid = F.col("bookings").isNotNull()
    figures = {"users": F.lit(1).cast("long"), "converted_users": flag(paid).cast("long"), "_rev": F.coalesce("revenue", F.lit(0).cast("decimal(38,10)"))}
    agg = per_value(_spenders(users, events, dims, tax), dims, figures)
    money = plain("_rev")
    return agg.select(
        "dim", "value", "users", "converted_users", rnd_pct("converted_users", "users", 1).alias("conversion_rate_pct"),
        rnd(money, 2).alias("total_revenue_eur"), rnd(div(money, "users"), 2).alias("arpu_eur"),
    )


def retention_by_all(users: DataFrame, events: DataFrame, dims: Mapping[str, str | None] = SEGMENT_DIMS, days=RETENTION_CHECKPOINTS_DAYS) -> DataFrame:
    """T2 — dim, value, total users and % retained per checkpoint.  ``events``
    may be raw events or the table of ``activity_bitmap``."""
    flags = retention_flags(users, events, days, keep=tuple(dims))
    agg = per_value(flags, dims, {"total_users": F.lit(1).cast("long")} | {f"_r{d}": F.col(f"retained_day{d}").cast("long") for d in days})
    return agg.select("dim", "value", "total_users", *[rnd(pct(f"_r{d}", "total_users"), 1).alias(f"day{d}_retention_pct") for d in days])
