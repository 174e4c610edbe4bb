"""Oracle SQL — retention, churn and cohorts (T0–T4, C1–C4)."""

from sql_oracle.bindings import BACK, DAYS, MIDX, MONTH, PCT, PEOPLE, R, SHARE


def T0(days=(1, 7, 30)):
    return f"{PEOPLE}\nSELECT user_id, " + ", ".join(f"{BACK(d)}::INT AS retained_day{d}" for d in days) + " FROM person"


def T1(days=(1, 7, 30)):
    cols = ", ".join(f"count_if({BACK(d)})::BIGINT AS day{d}_retained_users, {SHARE(BACK(d))} AS day{d}_retention_pct" for d in days)
    return f"{PEOPLE}\nSELECT count(*) AS total_users, {cols} FROM person"


def T2(dim, days=(1, 7, 30)):
    return f"{PEOPLE}\nSELECT {dim}, count(*) AS total_users, " + ", ".join(f"{SHARE(BACK(d))} AS day{d}_retention_pct" for d in days) + " FROM person GROUP BY ALL"


def T3(max_day=60, digits=4):
    back = "list_contains(days, CAST(signup_date + d::INT AS DATE))"
    return f"""{PEOPLE}
SELECT d::BIGINT AS days_since_signup, count_if({back})::BIGINT AS active_users, {SHARE(back, digits)} AS pct_of_users
FROM person, range({max_day + 1}) r(d) GROUP BY d
"""


def T4(inactive=30):
    gone = f"coalesce(latest <= (SELECT max(event_date) FROM app_events) - {inactive}, false)"
    return f"{PEOPLE}\nSELECT count(*) AS total_users, count_if({gone})::BIGINT AS churned_users, {SHARE(gone)} AS churn_rate_pct FROM person"


C1 = f"""
SELECT {MONTH('signup_date')} AS cohort_month, COUNT(*) AS cohort_size FROM app_users GROUP BY 1
"""

#: Months after signup of each user's active months, and the users of each cohort.
_MONTHS = f"""
member AS (SELECT user_id, {MONTH('signup_date')} AS cohort_month, {MIDX('signup_date')} AS born, count(*) OVER (PARTITION BY {MONTH('signup_date')}) AS cohort_size FROM app_users),
seen AS (
    SELECT cohort_month, any_value(cohort_size) AS cohort_size, any_value(born) AS born, {MIDX('event_date')} - born AS k, count(DISTINCT user_id) AS back,
           round(sum(revenue) FILTER (event_name = 'booking_completed'), 6) AS money, count(*) FILTER (event_name = 'booking_completed') AS bookings
    FROM app_events JOIN member USING (user_id) WHERE {MIDX('event_date')} >= born GROUP BY ALL
)"""

C2 = (
    _MONTHS
    + f"""
SELECT cohort_month, k AS months_since_signup, cohort_size, back AS retained_users, {R(PCT('back', 'cohort_size'), 1)} AS retention_pct FROM seen
"""
)


def C3(digits=2):
    return (
        _MONTHS
        + f"""
SELECT c.cohort_month, j::BIGINT AS months_since_signup,
       CASE WHEN c.born + j <= (SELECT max({MIDX('event_date')}) FROM app_events) THEN {R(PCT('coalesce(back, 0)', 'c.cohort_size'), digits)} END AS retention_pct
FROM (SELECT DISTINCT cohort_month, born, cohort_size FROM member) c
CROSS JOIN range((SELECT max(k) + 1 FROM seen)) r(j) LEFT JOIN seen ON seen.cohort_month = c.cohort_month AND seen.k = j
"""
    )


C4 = (
    _MONTHS
    + f"""
SELECT cohort_month, k AS months_since_signup, cohort_size, {R('money', 2)} AS revenue_eur, {R('money / cohort_size', 2)} AS revenue_per_cohort_user_eur
FROM seen WHERE bookings > 0
"""
)

#: Every cohort and offset up to the last month with an event, and what the cohort has spent until then.
C4_CUMULATIVE = f"""
member AS (SELECT user_id, {MONTH('signup_date')} AS cohort_month, {MIDX('signup_date')} AS born FROM app_users),
cohort AS (SELECT cohort_month, any_value(born) AS born, count(*) AS cohort_size FROM member GROUP BY cohort_month),
paid AS (
    SELECT cohort_month, {MIDX('event_date')} - born AS k, sum(revenue) AS money
    FROM app_events JOIN member USING (user_id) WHERE event_name = 'booking_completed' AND {MIDX('event_date')} >= born GROUP BY ALL
),
edge AS (SELECT max({MIDX('event_date')}) AS last FROM app_events),
cell AS (
    SELECT cohort.*, j, born + j <= last AS seen
    FROM cohort, edge, (SELECT unnest(range((SELECT last FROM edge) - (SELECT min(born) FROM cohort) + 1)) AS j)
)
SELECT cell.cohort_month, j::BIGINT AS months_since_signup, any_value(cohort_size) AS cohort_size,
       CASE WHEN any_value(seen) THEN {R('coalesce(round(sum(money) FILTER (k = j), 6), 0)', 2)} END AS revenue_eur,
       CASE WHEN any_value(seen) THEN {R('coalesce(round(sum(money), 6), 0)', 2)} END AS cumulative_revenue_eur,
       CASE WHEN any_value(seen) THEN {R('coalesce(round(sum(money), 6), 0) / any_value(cohort_size)', 2)} END AS cumulative_per_cohort_user_eur
FROM cell LEFT JOIN paid ON paid.cohort_month = cell.cohort_month AND k <= j
GROUP BY cell.cohort_month, j
"""
