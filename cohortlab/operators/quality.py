"""Data-quality operators (DQ1–DQ19).

Checks that read the same table share one scan: row-level rules are
``count_if`` columns of a single aggregate, unpivoted into rows afterwards.
Key checks are hash aggregates on the key; orphan checks are explicit
``left_anti`` joins; session checks are one aggregate per session.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.expr import day_offset, flag, rnd, rnd_pct
from cohortlab.plans.repeats import repeated_keys
from cohortlab.plans.scale import scalars, staged
from cohortlab.sources.schema import (
    COUNTRIES,
    DEFAULT_NULL_RATE_MAX,
    DEFAULT_TAXONOMY,
    END_DATE,
    EVENT_NAMES,
    EXPECTED_NULL_RATE_MAX,
    EXPERIMENT_GROUPS,
    PLATFORMS,
    START_DATE,
    DomainCheck,
    Taxonomy,
    default_domain_checks,
)

# Required columns per table (schema contract).
REQUIRED_COLUMNS = {
    "users": [
        "user_id", "signup_date", "country", "city", "platform",
        "acquisition_channel", "age_group", "experiment_group", "first_device_type",
    ],
    "events": [
        "event_id", "user_id", "event_time", "event_date", "session_id",
        "event_name", "product_area", "device_type", "revenue",
        "ride_distance_km", "payment_method",
    ],
    "experiments": [
        "user_id", "experiment_name", "experiment_group", "exposure_date",
        "converted", "conversion_date", "days_to_conversion",
    ],
}


# Type families accepted by the schema contract (ids may be text or integers).
_FAMILIES = {
    "id": ("string", "bigint", "int"),
    "date": ("date",),
    "timestamp": ("timestamp", "timestamp_ntz"),
    "text": ("string",),
    "number": ("double", "float", "bigint", "int", "decimal"),
    "integer": ("int", "bigint"),
    "flag": ("boolean",),
}
_EXPECTED_FAMILY = {
    "user_id": "id", "event_id": "id", "session_id": "text", "signup_date": "date", "event_date": "date",
    "exposure_date": "date", "conversion_date": "date", "event_time": "timestamp", "revenue": "number",
    "ride_distance_km": "number", "converted": "flag", "days_to_conversion": "integer",
}


def _type_family_ok(column: str, simple_type: str) -> bool:
    family = _EXPECTED_FAMILY.get(column, "text")
    base = simple_type.split("(")[0]
    return base in _FAMILIES[family]


def schema_contract(df: DataFrame, table: str) -> list[tuple]:
    """DQ17 — (table, column, expected family, actual type, status) for every
    required column; status is ok / missing / wrong_type.  Reads the schema
    only (no data pass)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for c in REQUIRED_COLUMNS[table]:
        fam = _EXPECTED_FAMILY.get(c, "text")
        if c not in actual:
            out.append((table, c, fam, None, "missing"))
        else:
            out.append((table, c, fam, actual[c], "ok" if _type_family_ok(c, actual[c]) else "wrong_type"))
    return out


def schema_report(tables: dict) -> DataFrame:
    """DQ17 — :func:`schema_contract` of each table as rows, with the number
    of values (``n_values``, NULL for a missing column) of every required
    column: one scan per table."""
    frames = []
    for name, df in tables.items():
        found = schema_contract(df, name)
        contract = df.sparkSession.createDataFrame(found, "table_name string, column_name string, expected string, actual string, status string")
        present = [c for _, c, _, actual, _ in found if actual is not None]
        counts = df.agg(*[F.count(F.col(_q(c))).alias(c) for c in present]).unpivot([], present, "column_name", "n_values") if present else None
        frames.append(contract.join(counts, "column_name", "left").select(*contract.columns, "n_values") if present else contract.withColumn("n_values", F.lit(None).cast("long")))
    return _union(frames)


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(users: DataFrame, events: DataFrame, experiments: DataFrame) -> DataFrame:
    """DQ1 — one row with the three table sizes."""
    return scalars(
        users.agg(F.count(F.lit(1)).alias("users_row_count")),
        events.agg(F.count(F.lit(1)).alias("events_row_count")),
        experiments.agg(F.count(F.lit(1)).alias("experiments_row_count")),
    )


def duplicate_keys(tables: dict, keys=(("users", "user_id"), ("events", "event_id"))) -> DataFrame:
    """DQ2 — key_checked, duplicate_value, occurrences (keys seen more than once).

    Keys that certainly occur once never leave their task (see
    :mod:`cohortlab.plans.repeats`)."""
    frames = []
    for table, key in keys:
        frames.append(
            repeated_keys(tables[table], [key])
            .select(F.lit(f"{table}.{key}").alias("key_checked"), F.col(key).cast("string").alias("duplicate_value"), "occurrences")
        )
    return _union(frames)


# Key column of each table.
KEYS = {"users": "user_id", "events": "event_id", "experiments": "user_id"}


def full_row_duplicates(tables: dict, keys: dict = KEYS) -> DataFrame:
    """DQ3 — per table: rows, distinct rows and fully duplicated rows.

    Equal rows share their key, so only rows whose key repeats are compared in
    full width: the repeated keys are found by a seen-twice table and staged,
    and the rows they select are grouped.  Tables without a known key are grouped as a whole."""
    frames = []
    for name, df in tables.items():
        key = keys.get(name)
        if key is None:
            per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
            row = per.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
        else:
            repeated = staged(repeated_keys(df, [key]).select(F.col(key).alias("_key")))
            suspects = df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
            extra = suspects.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("_x")).agg(F.coalesce(F.sum("_x"), F.lit(0)).cast("long").alias("duplicate_rows"))
            row = scalars(df.agg(F.count(F.lit(1)).alias("rows")), extra)
        frames.append(row.select(F.lit(name).alias("table_name"), "rows", (F.col("rows") - F.col("duplicate_rows")).alias("distinct_rows"), "duplicate_rows"))
    return _union(frames)


def orphans(users: DataFrame, children: dict, key: str = "user_id") -> DataFrame:
    """DQ4 — source_table, orphan_user_id, row_count for child keys missing in users."""
    parent = users.select(key).distinct()
    frames = []
    for name, child in children.items():
        # rows per key first (partial aggregation), then the anti join sees one row per key
        frames.append(
            child.groupBy(key)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .join(parent, key, "left_anti")
            .select(F.lit(name).alias("source_table"), F.col(key).cast("string").alias(f"orphan_{key}"), "row_count")
        )
    return _union(frames)


def events_before_signup(users: DataFrame, events: DataFrame) -> DataFrame:
    """DQ5 — events dated before their user's signup date.

    Violating (user, date) pairs are found on distinct activity days joined to
    users and staged, so their size is known: normally they are few and are
    broadcast, and the events stream past them without a shuffle; a large set
    is sort-merged with skew splitting."""
    bad_days = (
        events.select("user_id", "event_date")
        .distinct()
        .join(users.select("user_id", "signup_date"), "user_id")
        .filter(F.col("event_date") < F.col("signup_date"))
    )
    return events.select("event_id", "user_id", "event_date").join(staged(bad_days), ["user_id", "event_date"]).select(
        "event_id", "user_id", "event_date", "signup_date"
    )


def revenue_integrity(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """DQ6 — (issue, row_count) for negative revenue, positive revenue on a
    non-completed event, and completed bookings without positive revenue;
    one scan, three counters."""
    rev, name = F.col("revenue"), F.col("event_name")
    row = events.agg(
        F.count_if(rev < 0).alias("negative_revenue"),
        F.count_if(rev.isNotNull() & (rev > 0) & (name != tax.booking_completed)).alias("revenue_on_non_completed_booking"),
        F.count_if((name == tax.booking_completed) & (rev.isNull() | (rev <= 0))).alias("completed_booking_missing_revenue"),
    )
    cols = ["negative_revenue", "revenue_on_non_completed_booking", "completed_booking_missing_revenue"]
    return row.unpivot([], cols, "issue", "row_count")


def cancelled_revenue(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """DQ7 — cancelled / failed events that carry positive revenue."""
    rev = F.col("revenue")
    return events.agg(
        F.count_if(F.col("event_name").isin(tax.booking_cancelled, tax.payment_failed) & rev.isNotNull() & (rev > 0)).alias(
            "cancelled_or_failed_with_revenue"
        )
    )


NULLABLE_PROFILE = (("users", "age_group"), ("events", "revenue"), ("events", "ride_distance_km"), ("events", "payment_method"))


def null_profile(tables: dict, columns=NULLABLE_PROFILE) -> DataFrame:
    """DQ8 — column_checked, null_rate_pct (2 dp) for the named columns."""
    frames = []
    by_table: dict = {}
    for t, c in columns:
        by_table.setdefault(t, []).append(c)
    for t, cols in by_table.items():
        row = tables[t].agg(
            F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"{t}__{c}") for c in cols]
        )
        long = row.unpivot(["_n"], [f"{t}__{c}" for c in cols], "_col", "_nulls")
        frames.append(
            long.select(
                F.regexp_replace("_col", "__", ".").alias("column_checked"), rnd_pct("_nulls", "_n", 2).alias("null_rate_pct")
            )
        )
    return _union(frames)


def null_rates(df: DataFrame, table: str, limits: dict | None = None, default_max: float = DEFAULT_NULL_RATE_MAX) -> DataFrame:
    """DQ9 — null fraction of *every* column against its tolerated maximum.

    Output: table_name, column_name, null_count, rows, null_rate, max_allowed,
    exceeds (one scan of the table, unpivoted)."""
    limits = EXPECTED_NULL_RATE_MAX if limits is None else limits
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = row.unpivot(["rows"], cols, "column_name", "null_count")
    limit_map = F.create_map(*[F.lit(x) for c in cols for x in (c, float(limits.get(c, default_max)))])
    rate = F.try_divide(F.col("null_count").cast("double"), F.col("rows").cast("double"))
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.col("null_count").cast("long").alias("null_count"),
        "rows",
        rnd(rate, 6).alias("null_rate"),
        F.element_at(limit_map, F.col("column_name")).alias("max_allowed"),
        (F.coalesce(rate, F.lit(0.0)) > F.element_at(limit_map, F.col("column_name"))).alias("exceeds"),
    )


def missing_report(df: DataFrame, table: str) -> DataFrame:
    """DQ10 — columns with missing values: missing count and % (2 dp)."""
    r = null_rates(df, table)
    return r.filter(F.col("null_count") > 0).select(
        "table_name", "column_name", F.col("null_count").alias("missing"), rnd_pct("null_count", "rows", 2).alias("missing_pct")
    )


SQL_DOMAIN_CHECKS = [
    DomainCheck("users", "country", tuple(COUNTRIES)),
    DomainCheck("users", "platform", tuple(PLATFORMS)),
    DomainCheck("users", "experiment_group", tuple(EXPERIMENT_GROUPS)),
    DomainCheck("events", "event_name", tuple(EVENT_NAMES)),
]


def domain_violations(tables: dict, checks=None, nulls_are_invalid: bool = False) -> DataFrame:
    """DQ11 — column_checked, invalid_value, row_count for values outside the
    allowed set.  With ``nulls_are_invalid`` a NULL counts as an invalid value
    unless the rule drops nulls; otherwise NULLs are never reported (SQL
    ``NOT IN`` semantics).

    One scan per table for all of its rules: every row emits only its
    violating (column, value) pairs — an array filtered in place, normally
    empty — which one aggregate then counts."""
    checks = SQL_DOMAIN_CHECKS if checks is None else checks
    by_table: dict = {}
    for chk in checks:
        by_table.setdefault(chk.table, []).append(chk)
    frames = []
    for table, rules in by_table.items():
        items = []
        for chk in rules:
            c = F.col(chk.column)
            bad = ~c.isin(*chk.allowed)
            if nulls_are_invalid and not chk.drop_nulls:
                bad = bad | c.isNull()
            items.append(
                F.when(bad, F.struct(F.lit(f"{chk.table}.{chk.column}").alias("column_checked"), c.cast("string").alias("invalid_value")))
            )
        found = F.filter(F.array(*items), lambda x: x.isNotNull())
        frames.append(
            tables[table]
            .select(F.explode(found).alias("_v"))
            .groupBy(F.col("_v.column_checked").alias("column_checked"), F.col("_v.invalid_value").alias("invalid_value"))
            .agg(F.count(F.lit(1)).alias("row_count"))
        )
    return _union(frames)


def group_mismatch(users: DataFrame, experiments: DataFrame) -> DataFrame:
    """DQ12 — experiment rows whose group differs from the user's group."""
    u = users.select("user_id", F.col("experiment_group").alias("users_group"))
    return (
        experiments.select("user_id", F.col("experiment_group").alias("experiments_group"))
        .join(u, "user_id")
        .filter(F.col("experiments_group") != F.col("users_group"))
        .select("user_id", "experiments_group", "users_group")
    )


def date_span(df: DataFrame, col: str, label: str) -> DataFrame:
    """DQ13 — earliest, latest and span in days of a date column."""
    return df.agg(F.min(col).alias(f"earliest_{label}"), F.max(col).alias(f"latest_{label}")).select(
        "*", day_offset(f"latest_{label}", f"earliest_{label}").alias(f"{label}_span_days")
    )


def date_bounds(users: DataFrame, events: DataFrame, start: str = START_DATE, end: str = END_DATE, min_span: int = 300) -> DataFrame:
    """DQ14 — signups / events outside [start, end] and whether the signup
    span reaches ``min_span`` days."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    u = users.agg(
        F.count_if((F.col("signup_date") < s) | (F.col("signup_date") > e)).alias("signups_out_of_range"),
        day_offset(F.max("signup_date"), F.min("signup_date")).alias("signup_span_days"),
    )
    ev = events.agg(F.count_if((F.col("event_date") < s) | (F.col("event_date") > e)).alias("events_out_of_range"))
    return scalars(u, ev).select(
        "signups_out_of_range", "events_out_of_range", "signup_span_days", (F.col("signup_span_days") >= min_span).alias("span_ok")
    )


def session_flags(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    name = F.col("event_name")
    return events.groupBy("session_id").agg(
        F.max(flag(name == tax.search_started)).alias("has_search_started"),
        F.max(flag(name == tax.booking_started)).alias("has_booking_started"),
        F.max(flag(name == tax.booking_completed)).alias("has_booking_completed"),
    )


def session_prerequisites(events: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """DQ15 — sessions with a booking_completed but no booking_started, and with
    a booking_started but no search_started (set membership per session)."""
    sf = session_flags(events, tax)
    row = sf.agg(
        F.count_if((F.col("has_booking_completed") == 1) & (F.col("has_booking_started") == 0)).alias(
            "booking_completed_without_booking_started"
        ),
        F.count_if((F.col("has_booking_started") == 1) & (F.col("has_search_started") == 0)).alias(
            "booking_started_without_search_started"
        ),
    )
    return row.unpivot(
        [], ["booking_completed_without_booking_started", "booking_started_without_search_started"], "issue", "session_count"
    )


def converted_consistency(events: DataFrame, experiments: DataFrame, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """DQ16 — users in exactly one of {has a completed booking} and
    {flagged converted}: full outer join of the two distinct key sets."""
    booked = events.filter(F.col("event_name") == tax.booking_completed).select("user_id").distinct().withColumn("_b", F.lit(1))
    flagged = experiments.filter(F.col("converted")).select("user_id").distinct().withColumn("_f", F.lit(1))
    both = booked.join(flagged, "user_id", "full_outer")
    return both.agg(
        F.count_if(F.col("_b").isNull() | F.col("_f").isNull()).alias("mismatched_users"),
        F.count_if(F.col("_b").isNotNull() & F.col("_f").isNull()).alias("booked_not_flagged"),
        F.count_if(F.col("_b").isNull() & F.col("_f").isNotNull()).alias("flagged_not_booked"),
    )


def volume_checks(users: DataFrame, events: DataFrame, experiments: DataFrame, user_band=(4500, 5500), event_band=(100000, 200000)) -> DataFrame:
    """DQ18 — table volumes against expected bands, negative days_to_conversion."""
    row = scalars(
        users.agg(F.count(F.lit(1)).alias("users")),
        events.agg(F.count(F.lit(1)).alias("events")),
        experiments.agg(F.count_if(F.col("converted") & (F.col("days_to_conversion") < 0)).alias("negative_days_to_conversion")),
    )
    return row.select(
        "users",
        F.col("users").between(*user_band).alias("users_in_band"),
        "events",
        F.col("events").between(*event_band).alias("events_in_band"),
        "negative_days_to_conversion",
    )


def _checks(row: DataFrame, table: str, severities: dict) -> DataFrame:
    """One aggregated row with a column per check → rows of table_name,
    check_name, violations, severity (of a violated check) and message."""
    long = row.select(*severities).unpivot([], list(severities), "check_name", "v")
    sev = F.create_map(*[F.lit(x) for kv in severities.items() for x in kv])
    bad = F.coalesce(F.col("v"), F.lit(0)) > 0
    text = F.when(bad, F.format_string("%s: %d rows violate %s", F.lit(table), F.col("v"), F.col("check_name"))).otherwise(F.format_string("%s: %s holds", F.lit(table), F.col("check_name")))
    return long.select(
        F.lit(table).alias("table_name"),
        "check_name",
        F.coalesce(F.col("v"), F.lit(0)).cast("long").alias("violations"),
        F.when(bad, F.element_at(sev, F.col("check_name"))).otherwise(F.lit("ok")).alias("severity"),
        text.alias("message"),
    )


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _row_rules(start: str, end: str, tax: Taxonomy) -> list[tuple]:
    """(table, check, columns, condition of a violating row) of all row rules."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    rev, nm = F.col("revenue"), F.col("event_name")
    money = ("revenue", "event_name")
    rules = [
        ("events", "negative_revenue", ("revenue",), rev < 0),
        ("events", "revenue_on_non_completed_booking", money, rev.isNotNull() & (rev > 0) & (nm != tax.booking_completed)),
        ("events", "completed_booking_missing_revenue", money, (nm == tax.booking_completed) & (rev.isNull() | (rev <= 0))),
        ("events", "cancelled_or_failed_with_revenue", money, nm.isin(tax.booking_cancelled, tax.payment_failed) & rev.isNotNull() & (rev > 0)),
        ("events", "event_date_out_of_range", ("event_date",), (F.col("event_date") < s) | (F.col("event_date") > e)),
        ("users", "signup_date_out_of_range", ("signup_date",), (F.col("signup_date") < s) | (F.col("signup_date") > e)),
    ]
    for chk in default_domain_checks():
        c = F.col(chk.column)
        bad = (~c.isin(*chk.allowed)) if chk.drop_nulls else (c.isNull() | ~c.isin(*chk.allowed))
        rules.append((chk.table, f"domain_{chk.column}", (chk.column,), bad))
    return rules


def _scan_checks(df: DataFrame, name: str, rules: list[tuple]) -> DataFrame:
    """Row rules, null counts and the signup span of one table in one scan.
    A column with more nulls than its limit is a warning of its own."""
    cols = df.columns
    mine = [(check, cond) for table, check, needs, cond in rules if table == name and set(needs) <= set(cols)]
    aggs = [F.count(F.lit(1)).alias("_rows"), *[F.count_if(cond).alias(check) for check, cond in mine]]
    aggs += [F.count_if(F.col(_q(c)).isNull()).alias(f"_null_{c}") for c in cols]
    severities = {check: "fail" for check, _ in mine}
    if name == "users" and "signup_date" in cols:
        aggs.append(F.when(day_offset(F.max("signup_date"), F.min("signup_date")) < 300, 1).otherwise(0).alias("signup_span_below_300_days"))
        severities["signup_span_below_300_days"] = "warn"
    row = df.agg(*aggs)
    cells = [
        F.struct(
            F.lit(c).alias("c"),
            F.col(_q(f"_null_{c}")).alias("n"),
            F.lit(float(EXPECTED_NULL_RATE_MAX.get(c, DEFAULT_NULL_RATE_MAX))).alias("most"),
        )
        for c in cols
    ]
    # one row holds both kinds of results, so the table is read once
    checks = [
        F.struct(F.lit(k).alias("check_name"), F.col(k).cast("long").alias("n"), F.lit(v).alias("bad"), F.lit(None).cast("double").alias("rate"), F.lit(None).cast("double").alias("most"))
        for k, v in severities.items()
    ]
    rate = lambda x: F.coalesce(F.try_divide(x["n"].cast("double"), F.col("_rows").cast("double")), F.lit(0.0))
    over = F.filter(F.array(*cells), lambda x: rate(x) > x["most"])
    nulls = F.transform(
        over,
        lambda x: F.struct(F.concat(F.lit("null_rate_"), x["c"]).alias("check_name"), x["n"].cast("long").alias("n"), F.lit("warn").alias("bad"), rate(x).alias("rate"), x["most"].alias("most")),
    )
    found = row.select(F.explode(F.concat(F.array(*checks), nulls) if checks else nulls).alias("x")).select("x.*")
    bad = F.coalesce(F.col("n"), F.lit(0)) > 0
    said = (
        F.when(F.col("rate").isNotNull(), F.format_string("%s: %.2f%% of %s are null, at most %.2f%% are expected", F.lit(name), F.col("rate") * 100, F.regexp_replace("check_name", "^null_rate_", ""), F.col("most") * 100))
        .when(bad, F.format_string("%s: %d rows violate %s", F.lit(name), F.col("n"), F.col("check_name")))
        .otherwise(F.format_string("%s: %s holds", F.lit(name), F.col("check_name")))
    )
    return found.select(
        F.lit(name).alias("table_name"),
        "check_name",
        F.coalesce("n", F.lit(0)).cast("long").alias("violations"),
        F.when(bad, F.col("bad")).otherwise("ok").alias("severity"),
        said.alias("message"),
    )


def validation_report(users: DataFrame, events: DataFrame, experiments: DataFrame, start: str = START_DATE, end: str = END_DATE, tax: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """DQ19 — rows of (table_name, check_name, violations, severity, message).

    Severity is ``ok`` for zero violations, else ``fail`` (``warn`` for the
    span and for each column with too many nulls).  The last row (table
    ``all``, check ``overall``) has the number of failed checks and says
    PASSED or FAILED with the counts.  The schema contract (DQ17) is read off
    the schemas; a rule whose column is missing is left out, and the missing
    column is reported by ``required_columns``.

    Events are read for all row rules and null counts, for the keys (twice,
    the key column alone: a seen-twice table, then the suspects), and once for
    narrow rows per (user, day, session), which are staged: the checks that
    involve users and those of sessions are rolled up from them.  Every
    aggregate is partial+final, so a hot user, day or session is collapsed
    map-side; the collected report has a few dozen rows.
    """
    spark = users.sparkSession
    tables = {"users": users, "events": events, "experiments": experiments}

    def has(table: str, *columns: str) -> bool:
        return set(columns) <= set(tables[table].columns)

    frames = []
    for name, df in tables.items():
        broken = [(c, status) for _, c, _, _, status in schema_contract(df, name) if status != "ok"]
        said = f"{name}: " + (", ".join(f"{c} is {status.replace('_', ' ')}" for c, status in broken) or "required_columns holds")
        frames.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit("required_columns").alias("check_name"), F.lit(len(broken)).cast("long").alias("violations"), F.lit("fail" if broken else "ok").alias("severity"), F.lit(said).alias("message")))
    rules = _row_rules(start, end, tax)
    frames += [_scan_checks(df, name, rules) for name, df in tables.items()]

    for name, key in (("users", "user_id"), ("events", "event_id")):
        if has(name, key):
            dup = repeated_keys(tables[name], [key]).agg(F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias(f"duplicate_{key}"))
            frames.append(_checks(dup, name, {f"duplicate_{key}": "fail"}))

    by_session = has("events", "session_id", "event_name")
    keys = (["user_id", F.to_date("event_time").alias("_d")] if has("events", "user_id", "event_time") else []) + (["session_id"] if by_session else [])
    if keys and has("events", "event_name"):
        name = F.col("event_name")
        names = (tax.search_started, tax.booking_started, tax.booking_completed)
        visits = staged(events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.max(flag(name == x)).alias(f"has_{k}") for k, x in zip(("search_started", "booking_started", "booking_completed"), names)]))

    if has("users", "user_id", "signup_date") and has("events", "user_id", "event_time", "event_name") and has("experiments", "user_id", "converted"):
        known = users.groupBy("user_id").agg(F.min("signup_date").alias("_signup")).withColumn("_known", F.lit(1))
        per_day = visits.groupBy("user_id", "_d").agg(F.sum("_n").alias("_n"), F.max("has_booking_completed").alias("_booked"))
        active = per_day.join(known.select("user_id", "_signup"), "user_id", "left").groupBy("user_id").agg(
            F.sum("_n").alias("_n"), F.sum(F.when(F.col("_d") < F.col("_signup"), F.col("_n"))).alias("_early"), F.max("_booked").alias("_booked")
        )
        units = experiments.groupBy("user_id").agg(F.count(F.lit(1)).alias("_units"), F.max(F.col("converted").cast("int")).alias("_flagged"))
        people = active.join(units, "user_id", "full").join(known.select("user_id", "_known"), "user_id", "left")
        unknown = F.col("_known").isNull()
        row = people.agg(
            F.sum(F.when(unknown, F.col("_n"))).alias("orphan_user_id"),
            F.sum("_early").alias("event_before_signup"),
            F.sum(F.when(unknown, F.col("_units"))).alias("_x_orphans"),
            F.count_if(F.coalesce("_booked", F.lit(0)) != F.coalesce("_flagged", F.lit(0))).alias("converted_flag_mismatch"),
        )
        # one row per table, from one pass
        cells = [("events", "orphan_user_id", "orphan_user_id"), ("events", "event_before_signup", "event_before_signup"), ("experiments", "orphan_user_id", "_x_orphans"), ("experiments", "converted_flag_mismatch", "converted_flag_mismatch")]
        cells = [F.struct(F.lit(t).alias("t"), F.lit(c).alias("check_name"), F.coalesce(F.col(v), F.lit(0)).cast("long").alias("v")) for t, c, v in cells]
        both = row.select(F.explode(F.array(*cells)).alias("x")).select("x.*")
        frames.append(both.select(
            F.col("t").alias("table_name"), "check_name", F.col("v").alias("violations"), F.when(F.col("v") > 0, "fail").otherwise("ok").alias("severity"),
            F.when(F.col("v") > 0, F.format_string("%s: %d rows violate %s", "t", "v", "check_name")).otherwise(F.format_string("%s: %s holds", "t", "check_name")).alias("message"),
        ))

    if has("users", "user_id", "experiment_group") and has("experiments", "user_id", "experiment_group"):
        mism = group_mismatch(users, experiments).agg(F.count(F.lit(1)).alias("experiment_group_mismatch"))
        frames.append(_checks(mism, "experiments", {"experiment_group_mismatch": "fail"}))

    if by_session:
        names = ("sessions_booking_completed_without_booking_started", "sessions_booking_started_without_search_started")
        steps = ("has_search_started", "has_booking_started", "has_booking_completed")
        sp = visits.groupBy("session_id").agg(*[F.max(c).alias(c) for c in steps]).agg(
            F.count_if((F.col("has_booking_completed") == 1) & (F.col("has_booking_started") == 0)).alias(names[0]),
            F.count_if((F.col("has_booking_started") == 1) & (F.col("has_search_started") == 0)).alias(names[1]),
        )
        frames.append(_checks(sp, "events", dict.fromkeys(names, "fail")))

    report = _union(frames)
    columns = report.columns
    whole = report.agg(F.collect_list(F.struct(*columns)).alias("_rows"))
    n = lambda kind: F.size(F.filter("_rows", lambda r: r["severity"] == kind))
    said = F.format_string("%s: %d failed, %d warnings, %d checks", F.when(n("fail") > 0, "FAILED").otherwise("PASSED"), n("fail"), n("warn"), F.size("_rows"))
    overall = F.struct(F.lit("all").alias("table_name"), F.lit("overall").alias("check_name"), n("fail").cast("long").alias("violations"), F.when(n("fail") > 0, "fail").otherwise("ok").alias("severity"), said.alias("message"))
    return whole.select(F.inline(F.concat("_rows", F.array(overall))))
