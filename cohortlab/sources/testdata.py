"""Adapters from the driver's TPC-H-style parquet tables to the canonical model.

Two bindings (documented in FIXTURES.md):

* :func:`clickstream` (binding E) — ``events`` + ``customer`` → users / events /
  experiments for funnels, sessions, adoption, KPIs and A/B readouts.
* :func:`order_history` (binding O) — ``orders`` as bookings for month/year
  cohorts, churn and value tiers.

Both are plain projections, one aggregate (first activity per customer) and
joins against the 25-row ``nation`` / 5-row ``region`` dimensions, which the
planner broadcasts only because their size estimate is below the broadcast
threshold (otherwise it sort-merges).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.sources.experiments import derive_experiments
from cohortlab.sources.schema import EVENT_PRODUCT_AREA, EXPERIMENT_GROUPS, PAYMENT_METHODS, LazyTables


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _pick(idx_sql: str, values: list) -> Column:
    """``values[idx]`` for a small literal list, as one SQL CASE expression."""
    cases = " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(values))
    return F.expr(f"CASE {idx_sql} {cases} END")


# The (event_type, value band) → event_name rule of binding E.
_EVENT_BANDS = {
    "signup": [(60, "app_open"), (110, "location_permission_granted"), (None, "favourite_location_added")],
    "view": [(40, "search_started"), (140, "search_completed"), (None, "promo_viewed")],
    "click": [(40, "ride_option_viewed"), (140, "rating_submitted"), (None, "notification_enabled")],
    "purchase": [(60, "booking_cancelled"), (150, "booking_started"), (None, "booking_completed")],
    "error": [(80, "payment_failed"), (None, "support_contacted")],
}
_DEVICES_BY_MOD3 = ["iOS", "Android", "Web"]
_DEVICES_BY_MOD4 = ["iOS", "Android", "Web", "iOS"]
_PAYMENT_EVENTS = ["booking_completed", "payment_failed"]
_AGE_BANDS = [(2000, "18-24"), (4000, "25-34"), (6000, "35-44"), (8000, "45-54"), (None, "55+")]


def event_name_expr(event_type: str = "event_type", value: str = "value") -> Column:
    whens = []
    for etype, bands in _EVENT_BANDS.items():
        for bound, name in bands:
            cond = f"{event_type} = {_lit(etype)}" + (f" AND {value} < {bound}" if bound is not None else "")
            whens.append(f"WHEN {cond} THEN {_lit(name)}")
    return F.expr("CASE " + " ".join(whens) + " END")


def product_area_expr(event_name: str = "event_name") -> Column:
    cases = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in EVENT_PRODUCT_AREA.items())
    return F.expr(f"CASE {event_name} {cases} END")


def _age_group(acctbal: str = "c_acctbal") -> Column:
    whens = [f"WHEN {acctbal} < 0 THEN NULL"]
    for bound, label in _AGE_BANDS:
        whens.append(f"WHEN {acctbal} < {bound} THEN {_lit(label)}" if bound is not None else f"ELSE {_lit(label)}")
    return F.expr("CASE " + " ".join(whens) + " END")


def _customer_users(spark: SparkSession, sf_dir: str, first_date: DataFrame, fallback_start: str) -> DataFrame:
    """One user per customer; ``first_date`` (user_id, first_date) gives signup."""
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    key = F.col("c_custkey")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
        .join(first_date, key == first_date.user_id, "left")
        .select(
            key.alias("user_id"),
            F.coalesce(
                F.col("first_date"), F.date_add(F.lit(fallback_start).cast("date"), (key % 30).cast("int"))
            ).alias("signup_date"),
            F.col("r_name").alias("country"),
            F.col("n_name").alias("city"),
            _pick("c_custkey % 3", _DEVICES_BY_MOD3).alias("platform"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            _age_group("c_acctbal").alias("age_group"),
            _pick("c_custkey % 2", EXPERIMENT_GROUPS).alias("experiment_group"),
            _pick("c_custkey % 4", _DEVICES_BY_MOD4).alias("first_device_type"),
        )
    )


def clickstream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _read(spark, sf_dir, "events")
    name = event_name_expr("event_type", "value")
    ev = raw.select(
        F.col("event_id"),
        F.col("user_id"),
        F.col("ts").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        name.alias("event_name"),
        F.col("value"),
        F.col("props"),
    )
    return ev.select(
        "event_id",
        "user_id",
        "event_time",
        "event_date",
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("event_date", "yyyy-MM-dd")).alias(
            "session_id"
        ),
        "event_name",
        product_area_expr("event_name").alias("product_area"),
        _pick("event_id % 3", _DEVICES_BY_MOD3).alias("device_type"),
        F.expr("CASE WHEN event_name = 'booking_completed' THEN value END").alias("revenue"),
        F.expr("CASE WHEN startswith(event_name, 'booking_') THEN value / 10.0D END").alias("ride_distance_km"),
        F.expr(
            "CASE WHEN event_name IN (" + ", ".join(_lit(x) for x in _PAYMENT_EVENTS) + ") THEN "
            + "CASE CAST(get_json_object(props, '$.k') AS BIGINT) % 6 "
            + " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(PAYMENT_METHODS))
            + " END END"
        ).alias("payment_method"),
    )


def _first_date(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.min("event_date").alias("first_date"))


def clickstream(spark: SparkSession, sf_dir: str) -> LazyTables:
    """Binding E: clickstream events + customers."""
    return LazyTables(
        users=lambda t: _customer_users(spark, sf_dir, _first_date(t.events), "2024-01-01"),
        events=lambda t: clickstream_events(spark, sf_dir),
        experiments=lambda t: derive_experiments(t.users, t.events),
    )


# Order status → booking event of binding O, and its conversion bar.
_ORDER_STATUS_EVENT = {"F": "booking_completed", "O": "booking_started", "P": "booking_cancelled"}
ORDER_CONVERSION_MIN_PRICE = 400000.0


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    status_map = F.create_map(*[F.lit(x) for kv in _ORDER_STATUS_EVENT.items() for x in kv])
    name = F.element_at(status_map, F.col("o_orderstatus"))
    date = F.to_date("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("event_time"),
        date.alias("event_date"),
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), F.date_format(date, "yyyy-MM-dd")).alias("session_id"),
        name.alias("event_name"),
        F.lit("Booking").alias("product_area"),
        _pick("o_orderkey % 3", _DEVICES_BY_MOD3).alias("device_type"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("revenue"),
        F.lit(None).cast("double").alias("ride_distance_km"),
        F.lit(None).cast("string").alias("payment_method"),
    )


def order_history(spark: SparkSession, sf_dir: str) -> LazyTables:
    """Binding O: orders as booking events over a multi-year span."""
    big = (F.col("event_name") == "booking_completed") & (F.col("revenue") >= ORDER_CONVERSION_MIN_PRICE)
    return LazyTables(
        users=lambda t: _customer_users(spark, sf_dir, _first_date(t.events), "1995-01-01"),
        events=lambda t: order_events(spark, sf_dir),
        experiments=lambda t: derive_experiments(t.users, t.events, conversion_filter=big),
    )


BINDINGS = {"E": clickstream, "O": order_history}
