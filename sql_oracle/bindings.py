"""DuckDB text of the two testdata bindings (FIXTURES.md) and SQL macros.

The oracle is an independent SQL formulation of every operator, run by
DuckDB over the same parquet tables.  Each query body refers to the CTEs
``app_users``, ``app_events`` and ``app_experiments`` defined here.
"""

from __future__ import annotations


def R(x: str, k: int) -> str:
    """Round half away from zero (same formula as ``cohortlab.functions.expr.rnd``)."""
    p = f"CAST({10 ** k} AS DOUBLE)"
    v = f"CAST(({x}) AS DOUBLE)"
    return f"((CASE WHEN {v} < 0 THEN -(floor(abs({v}) * {p} + 0.5) / {p}) ELSE floor(abs({v}) * {p} + 0.5) / {p} END) + CAST(0.0 AS DOUBLE))"


def PCT(n: str, d: str) -> str:
    return f"(CAST(100.0 AS DOUBLE) * CAST(({n}) AS DOUBLE) / CAST(NULLIF(({d}), 0) AS DOUBLE))"


def DIV(n: str, d: str) -> str:
    return f"(CAST(({n}) AS DOUBLE) / CAST(NULLIF(({d}), 0) AS DOUBLE))"


#: One row per user: the user's columns, the set of event names and of active
#: days, booking revenue as plain sum, and counts.  Sets are lists.
PEOPLE = """
person AS (
    SELECT u.*, coalesce(h.names, []) AS names, coalesce(h.days, []) AS days, h.latest, h.spent,
           coalesce(h.priced, 0) AS priced, coalesce(h.booked, 0) AS booked, coalesce(h.n, 0) AS n_events, h.avg_km
    FROM app_users u LEFT JOIN (
        SELECT user_id, list(DISTINCT event_name) AS names, list(DISTINCT event_date) AS days, max(event_date) AS latest,
               sum(revenue) FILTER (event_name = 'booking_completed') AS spent,
               count(revenue) FILTER (event_name = 'booking_completed') AS priced,
               count(*) FILTER (event_name = 'booking_completed') AS booked, count(*) AS n,
               avg(ride_distance_km) FILTER (event_name = 'booking_completed') AS avg_km
        FROM app_events GROUP BY user_id
    ) h USING (user_id)
)"""


def HAS(name: str) -> str:
    """The person has an event of this name."""
    return f"list_contains(names, '{name}')"


def BACK(day: int) -> str:
    """The person was active ``day`` days after signup."""
    return f"list_contains(days, CAST(signup_date + {day} AS DATE))"


def SHARE(condition: str, digits: int = 1) -> str:
    """Percentage of rows for which ``condition`` holds."""
    return R(f"100.0 * avg(CAST(({condition}) AS INTEGER))", digits)


def WEEK(d: str) -> str:
    return f"strftime({d}, '%Y-W%W')"


def MONTH(d: str) -> str:
    return f"strftime({d}, '%Y-%m')"


def MIDX(d: str) -> str:
    return f"(CAST(year({d}) AS BIGINT) * 12 + CAST(month({d}) AS BIGINT))"


def DAYS(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', {earlier}, {later}) AS BIGINT)"


_AREA = """CASE e0.event_name
        WHEN 'app_open' THEN 'Engagement' WHEN 'signup_completed' THEN 'Onboarding'
        WHEN 'location_permission_granted' THEN 'Onboarding' WHEN 'search_started' THEN 'Search'
        WHEN 'search_completed' THEN 'Search' WHEN 'ride_option_viewed' THEN 'Search'
        WHEN 'promo_viewed' THEN 'Engagement' WHEN 'booking_started' THEN 'Booking'
        WHEN 'booking_completed' THEN 'Booking' WHEN 'booking_cancelled' THEN 'Booking'
        WHEN 'favourite_location_added' THEN 'Engagement' WHEN 'notification_enabled' THEN 'Engagement'
        WHEN 'support_contacted' THEN 'Support' WHEN 'payment_failed' THEN 'Payments'
        WHEN 'rating_submitted' THEN 'Engagement' END"""

_USERS = """app_users AS (
    SELECT c.c_custkey AS user_id,
           COALESCE(f.first_date, CAST(DATE '{start}' + CAST(c.c_custkey % 30 AS INTEGER) AS DATE)) AS signup_date,
           r.r_name AS country,
           n.n_name AS city,
           CASE c.c_custkey % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS platform,
           c.c_mktsegment AS acquisition_channel,
           CASE WHEN c.c_acctbal < 0 THEN NULL
                WHEN c.c_acctbal < 2000 THEN '18-24' WHEN c.c_acctbal < 4000 THEN '25-34'
                WHEN c.c_acctbal < 6000 THEN '35-44' WHEN c.c_acctbal < 8000 THEN '45-54'
                ELSE '55+' END AS age_group,
           CASE c.c_custkey % 2 WHEN 0 THEN 'control' ELSE 'treatment' END AS experiment_group,
           CASE c.c_custkey % 4 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Web' ELSE 'iOS' END AS first_device_type
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN (SELECT user_id, MIN(event_date) AS first_date FROM app_events GROUP BY user_id) f
           ON f.user_id = c.c_custkey
)"""

_EXPERIMENTS = """app_experiments AS (
    SELECT u.user_id,
           'simplified_booking_flow' AS experiment_name,
           u.experiment_group,
           u.signup_date AS exposure_date,
           b.conversion_date IS NOT NULL AS converted,
           b.conversion_date,
           CAST(date_diff('day', u.signup_date, b.conversion_date) AS INTEGER) AS days_to_conversion
    FROM app_users u
    LEFT JOIN (SELECT user_id, MIN(event_date) AS conversion_date
               FROM app_events WHERE {conv} GROUP BY user_id) b ON b.user_id = u.user_id
)"""

BINDING_E = (
    """WITH e0 AS (
    SELECT event_id, user_id, ts, value, props,
           CASE
             WHEN event_type = 'signup' AND value < 60 THEN 'app_open'
             WHEN event_type = 'signup' AND value < 110 THEN 'location_permission_granted'
             WHEN event_type = 'signup' THEN 'favourite_location_added'
             WHEN event_type = 'view' AND value < 40 THEN 'search_started'
             WHEN event_type = 'view' AND value < 140 THEN 'search_completed'
             WHEN event_type = 'view' THEN 'promo_viewed'
             WHEN event_type = 'click' AND value < 40 THEN 'ride_option_viewed'
             WHEN event_type = 'click' AND value < 140 THEN 'rating_submitted'
             WHEN event_type = 'click' THEN 'notification_enabled'
             WHEN event_type = 'purchase' AND value < 60 THEN 'booking_cancelled'
             WHEN event_type = 'purchase' AND value < 150 THEN 'booking_started'
             WHEN event_type = 'purchase' THEN 'booking_completed'
             WHEN event_type = 'error' AND value < 80 THEN 'payment_failed'
             WHEN event_type = 'error' THEN 'support_contacted'
           END AS event_name
    FROM events
),
app_events AS (
    SELECT e0.event_id,
           e0.user_id,
           e0.ts AS event_time,
           CAST(e0.ts AS DATE) AS event_date,
           CAST(e0.user_id AS VARCHAR) || '_' || strftime(CAST(e0.ts AS DATE), '%Y-%m-%d') AS session_id,
           e0.event_name,
           """
    + _AREA
    + """ AS product_area,
           CASE e0.event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS device_type,
           CASE WHEN e0.event_name = 'booking_completed' THEN e0.value END AS revenue,
           CASE WHEN starts_with(e0.event_name, 'booking_') THEN e0.value / 10.0 END AS ride_distance_km,
           CASE WHEN e0.event_name IN ('booking_completed', 'payment_failed') THEN
                CASE CAST(json_extract_string(e0.props, '$.k') AS BIGINT) % 6
                  WHEN 0 THEN 'Card' WHEN 1 THEN 'PayPal' WHEN 2 THEN 'Apple Pay'
                  WHEN 3 THEN 'Google Pay' WHEN 4 THEN 'Cash' WHEN 5 THEN 'None' END
           END AS payment_method
    FROM e0
),
"""
    + _USERS.format(start="2024-01-01")
    + ",\n"
    + _EXPERIMENTS.format(conv="event_name = 'booking_completed'")
)

BINDING_O = (
    """WITH app_events AS (
    SELECT o_orderkey AS event_id,
           o_custkey AS user_id,
           o_orderdate AS event_time,
           CAST(o_orderdate AS DATE) AS event_date,
           CAST(o_custkey AS VARCHAR) || '_' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS session_id,
           CASE o_orderstatus WHEN 'F' THEN 'booking_completed' WHEN 'O' THEN 'booking_started'
                              WHEN 'P' THEN 'booking_cancelled' END AS event_name,
           'Booking' AS product_area,
           CASE o_orderkey % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS device_type,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS revenue,
           CAST(NULL AS DOUBLE) AS ride_distance_km,
           CAST(NULL AS VARCHAR) AS payment_method
    FROM orders
),
"""
    + _USERS.format(start="1995-01-01")
    + ",\n"
    + _EXPERIMENTS.format(conv="event_name = 'booking_completed' AND revenue >= 400000")
)

BINDINGS = {"E": BINDING_E, "O": BINDING_O}


def with_binding(binding: str, body: str) -> str:
    """Prefix a query body with the binding CTEs.

    A body is either a plain ``SELECT`` or a list of further CTEs
    (``name AS (...), ...``) followed by its final ``SELECT``.
    """
    body = body.strip()
    head = BINDINGS[binding]
    if body.upper().startswith("SELECT"):
        return head + "\n" + body
    return head + ",\n" + body


def ALL_DIMS(family, dims: dict) -> str:
    """The tables of a family (dimension, null label) -> body, each body a
    plain SELECT or one over ``person``, one below the other as (dim, value)."""
    bodies = {d: family(d, label).replace(PEOPLE, "").strip() for d, label in dims.items()}
    union = "\nUNION ALL\n".join(f"SELECT '{d}' AS dim, {d} AS value, * EXCLUDE ({d}) FROM ({body})" for d, body in bodies.items())
    return f"{PEOPLE}\n{union}"
