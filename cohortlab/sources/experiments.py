"""IO5 — derive the ``experiments`` table from users and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.sources.schema import EXPERIMENT_NAME


def derive_experiments(
    users: DataFrame,
    events: DataFrame,
    conversion_filter: Column | None = None,
    experiment_name: str = EXPERIMENT_NAME,
) -> DataFrame:
    """One row per user: exposure at signup, converted ⇔ a converting event exists,
    conversion_date = first converting event date, days_to_conversion = the gap.

    The per-user minimum is a partial (map-side) aggregate, so a user holding a
    large share of events still collapses to one row per map task before the
    shuffle; the join back to users is on the user key.
    """
    if conversion_filter is None:
        conversion_filter = F.col("event_name") == "booking_completed"
    first = (
        events.filter(conversion_filter)
        .groupBy("user_id")
        .agg(F.min("event_date").alias("conversion_date"))
    )
    return users.select("user_id", "signup_date", "experiment_group").join(first, "user_id", "left").select(
        "user_id",
        F.lit(experiment_name).alias("experiment_name"),
        "experiment_group",
        F.col("signup_date").alias("exposure_date"),
        F.col("conversion_date").isNotNull().alias("converted"),
        "conversion_date",
        F.datediff("conversion_date", "signup_date").alias("days_to_conversion"),
    )
