"""Canonical data model: ``users``, ``events``, ``experiments``.

Operators address columns by these names.  Explicit ``StructType``s are used
for every file read (no schema inference).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

USERS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("signup_date", T.DateType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("city", T.StringType(), False),
        T.StructField("platform", T.StringType(), False),
        T.StructField("acquisition_channel", T.StringType(), False),
        T.StructField("age_group", T.StringType(), True),
        T.StructField("experiment_group", T.StringType(), False),
        T.StructField("first_device_type", T.StringType(), False),
    ]
)

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("event_date", T.DateType(), False),
        T.StructField("session_id", T.StringType(), False),
        T.StructField("event_name", T.StringType(), False),
        T.StructField("product_area", T.StringType(), False),
        T.StructField("device_type", T.StringType(), False),
        T.StructField("revenue", T.DoubleType(), True),
        T.StructField("ride_distance_km", T.DoubleType(), True),
        T.StructField("payment_method", T.StringType(), True),
    ]
)

EXPERIMENTS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("experiment_name", T.StringType(), False),
        T.StructField("experiment_group", T.StringType(), False),
        T.StructField("exposure_date", T.DateType(), False),
        T.StructField("converted", T.BooleanType(), False),
        T.StructField("conversion_date", T.DateType(), True),
        T.StructField("days_to_conversion", T.IntegerType(), True),
    ]
)

SCHEMAS = {"users": USERS_SCHEMA, "events": EVENTS_SCHEMA, "experiments": EXPERIMENTS_SCHEMA}

# The categorical domains, event taxonomy and product-area map of
# the data model (they must equal the source system's for results to match).
COUNTRIES = ["Germany", "Austria", "Spain", "Netherlands", "France"]
PLATFORMS = ["iOS", "Android", "Web"]
ACQUISITION_CHANNELS = ["Organic", "Paid Search", "Paid Social", "Referral", "Partnership", "Direct"]
AGE_GROUPS = ["18-24", "25-34", "35-44", "45-54", "55+"]
EXPERIMENT_GROUPS = ["control", "treatment"]
DEVICE_TYPES = ["iOS", "Android", "Web"]
EVENT_NAMES = [
    "app_open",
    "signup_completed",
    "location_permission_granted",
    "search_started",
    "search_completed",
    "ride_option_viewed",
    "promo_viewed",
    "booking_started",
    "booking_completed",
    "booking_cancelled",
    "favourite_location_added",
    "notification_enabled",
    "support_contacted",
    "payment_failed",
    "rating_submitted",
]
EVENT_PRODUCT_AREA = {
    "app_open": "Engagement",
    "signup_completed": "Onboarding",
    "location_permission_granted": "Onboarding",
    "search_started": "Search",
    "search_completed": "Search",
    "ride_option_viewed": "Search",
    "promo_viewed": "Engagement",
    "booking_started": "Booking",
    "booking_completed": "Booking",
    "booking_cancelled": "Booking",
    "favourite_location_added": "Engagement",
    "notification_enabled": "Engagement",
    "support_contacted": "Support",
    "payment_failed": "Payments",
    "rating_submitted": "Engagement",
}
PRODUCT_AREAS = ["Onboarding", "Search", "Booking", "Payments", "Engagement", "Support"]
PAYMENT_METHODS = ["Card", "PayPal", "Apple Pay", "Google Pay", "Cash", "None"]
EXPERIMENT_NAME = "simplified_booking_flow"

# Thresholds and windows used as operator defaults.
ACTIVATION_WINDOW_DAYS = 7
CHURN_INACTIVITY_DAYS = 30
RETENTION_CHECKPOINTS_DAYS = (1, 7, 30)
START_DATE = "2024-01-01"
END_DATE = "2025-06-30"

# Maximum tolerated null fraction per column before a warning (default 1%).
EXPECTED_NULL_RATE_MAX = {
    "age_group": 0.08,
    "revenue": 0.99,
    "ride_distance_km": 0.97,
    "payment_method": 0.99,
    "conversion_date": 0.90,
    "days_to_conversion": 0.90,
}
DEFAULT_NULL_RATE_MAX = 0.01


@dataclass(frozen=True)
class Taxonomy:
    """Event names the operators look for; defaults follow the data model."""

    search_started: str = "search_started"
    search_completed: str = "search_completed"
    booking_started: str = "booking_started"
    booking_completed: str = "booking_completed"
    booking_cancelled: str = "booking_cancelled"
    payment_failed: str = "payment_failed"
    features: tuple = ("notification_enabled", "favourite_location_added", "promo_viewed")
    funnel: tuple = ("search_started", "booking_started", "booking_completed")
    funnel_labels: tuple = ("signup", "search_started", "booking_started", "booking_completed")


DEFAULT_TAXONOMY = Taxonomy()


@dataclass(frozen=True)
class DomainCheck:
    table: str
    column: str
    allowed: tuple
    drop_nulls: bool = False


def default_domain_checks() -> list[DomainCheck]:
    """The ten categorical-domain rules of the validation job."""
    return [
        DomainCheck("users", "country", tuple(COUNTRIES)),
        DomainCheck("users", "platform", tuple(PLATFORMS)),
        DomainCheck("users", "acquisition_channel", tuple(ACQUISITION_CHANNELS)),
        DomainCheck("users", "age_group", tuple(AGE_GROUPS), drop_nulls=True),
        DomainCheck("users", "experiment_group", tuple(EXPERIMENT_GROUPS)),
        DomainCheck("events", "event_name", tuple(EVENT_NAMES)),
        DomainCheck("events", "product_area", tuple(PRODUCT_AREAS)),
        DomainCheck("events", "device_type", tuple(DEVICE_TYPES)),
        DomainCheck("events", "payment_method", tuple(PAYMENT_METHODS), drop_nulls=True),
        DomainCheck("experiments", "experiment_group", tuple(EXPERIMENT_GROUPS)),
    ]


@dataclass
class Tables:
    """The three canonical tables handed to operators."""

    users: object
    events: object
    experiments: object = None
    extra: dict = field(default_factory=dict)


class LazyTables:
    """Tables whose DataFrames are defined on first access.

    Building a DataFrame costs analysis round trips to the JVM; an operator
    that only reads ``events`` never pays for defining ``users`` or
    ``experiments``.  Builders receive this object so they can refer to the
    other tables.
    """

    def __init__(self, users, events, experiments=None):
        self._builders = {"users": users, "events": events, "experiments": experiments}
        self._built: dict = {}

    def _get(self, name):
        if name not in self._built:
            builder = self._builders[name]
            self._built[name] = None if builder is None else builder(self)
        return self._built[name]

    @property
    def users(self):
        return self._get("users")

    @property
    def events(self):
        return self._get("events")

    @property
    def experiments(self):
        return self._get("experiments")
