"""Oracle SQL — segmentation and descriptive statistics (S1–S9)."""

from sql_oracle.bindings import BACK, PEOPLE, R, SHARE

#: Revenue is the plain sum; only ties are settled on nine decimals.
def S1(dim, null_label=None):
    key = f"coalesce({dim}, '{null_label}')" if null_label else dim
    return f"""{PEOPLE}
SELECT {key} AS {dim}, count(*) AS users, count_if(booked > 0)::BIGINT AS converted_users, {SHARE('booked > 0')} AS conversion_rate_pct,
       {R('coalesce(sum(spent), 0)', 2)} AS total_revenue_eur, {R('coalesce(sum(spent), 0) / count(*)', 2)} AS arpu_eur
FROM person GROUP BY 1
"""


# Tier labels.
S2 = f"""{PEOPLE},
tier AS (
    SELECT coalesce(spent, 0) AS spent, CASE WHEN coalesce(spent, 0) > 0
             THEN ['Low value', 'Mid value', 'High value'][ntile(3) OVER (PARTITION BY coalesce(spent, 0) > 0 ORDER BY round(spent, 9), user_id)]
             ELSE 'Non-payer' END AS revenue_segment
    FROM person
)
SELECT revenue_segment, count(*) AS users, {R('100.0 * count(*) / sum(count(*)) OVER ()', 1)} AS pct_of_users, {R('sum(spent)', 2)} AS segment_revenue_eur,
       {R("100.0 * sum(spent) / (SELECT sum(revenue) FROM app_events WHERE event_name = 'booking_completed')", 1)} AS pct_of_total_revenue,
       {R('avg(spent)', 2)} AS avg_revenue_per_user_eur
FROM tier GROUP BY revenue_segment
"""


def S3(dims=("country", "acquisition_channel"), k=10):
    d = ", ".join(dims)
    return f"""{PEOPLE}
SELECT {d}, count(*) AS users, {R('coalesce(sum(spent), 0)', 2)} AS revenue_eur, {R('coalesce(sum(spent), 0) / count(*)', 2)} AS arpu_eur,
       (rank() OVER (ORDER BY round(coalesce(sum(spent), 0), 6) DESC))::BIGINT AS revenue_rank
FROM person GROUP BY {d} ORDER BY revenue_rank, {d} LIMIT {k}
"""


def S4(dim="acquisition_channel"):
    return f"""{PEOPLE},
sized AS (SELECT {dim}, count(*) AS users, {SHARE('booked > 0')} AS rate FROM person GROUP BY ALL),
judged AS (SELECT *, avg(users) OVER () AS usual, avg(rate) OVER () AS mean FROM sized)
SELECT {dim}, users, rate AS conversion_rate_pct, {R('mean', 1)} AS overall_avg_conversion_rate_pct, {R('rate - mean', 1)} AS gap_vs_average_pp
FROM judged WHERE users >= usual AND rate < mean
"""


def S5(dim="acquisition_channel", day=30):
    return f"""{PEOPLE},
rated AS (SELECT {dim}, grouping({dim}) AS whole, count(*) AS users, {SHARE(BACK(day))} AS rate FROM person GROUP BY ROLLUP ({dim}))
SELECT part.{dim}, part.users, part.rate AS day{day}_retention_pct, whole.rate AS overall_day{day}_retention_pct, {R('part.rate - whole.rate', 1)} AS gap_vs_average_pp
FROM rated part JOIN rated whole ON part.whole = 0 AND whole.whole = 1 AND part.rate < whole.rate
"""


def _features(money: str, km: str) -> str:
    return f"""{PEOPLE},
user_features AS (
    SELECT p.user_id, p.n_events AS total_events, p.booked AS total_bookings, {money} AS lifetime_revenue, {km} AS avg_ride_distance_km,
           x.days_to_conversion::BIGINT AS days_to_conversion
    FROM person p LEFT JOIN app_experiments x USING (user_id)
)"""


S6_CTE = _features(R("coalesce(spent, 0)", 2), R("avg_km", 4))
S7_CTE = _features("coalesce(spent, 0)", "avg_km")

S6 = S6_CTE + "\nSELECT * FROM user_features"

_FEATS = ["total_events", "total_bookings", "lifetime_revenue", "avg_ride_distance_km", "days_to_conversion"]


def S7(digits=4):
    parts = []
    for a in _FEATS:
        for b in _FEATS:
            parts.append(
                f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {R(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', digits)} AS correlation FROM user_features"
            )
    return S7_CTE + "\n" + "\nUNION ALL\n".join(parts)


def S8(table, cols, digits=4):
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"""SELECT '{c}' AS column, COUNT({c}) AS count,
       {R(f'AVG({v})', digits)} AS mean, {R(f'stddev_samp({v})', digits)} AS std,
       {R(f'MIN({v})', digits)} AS min,
       {R(f'quantile_cont({v}, 0.25)', digits)} AS p25,
       {R(f'quantile_cont({v}, 0.5)', digits)} AS p50,
       {R(f'quantile_cont({v}, 0.75)', digits)} AS p75,
       {R(f'MAX({v})', digits)} AS max
FROM {table} WHERE {c} IS NOT NULL HAVING COUNT({c}) > 0"""
        )
    return "\nUNION ALL\n".join(parts)


def S9(table, col, bins=30, digits=6):
    """A value lies in the last bin whose lower edge it reaches; the edges are
    lo + i * width, a constant column gets half a unit to both sides."""
    return f"""
vals AS (SELECT CAST({col} AS DOUBLE) AS x FROM {table} WHERE {col} IS NOT NULL),
span AS (SELECT min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS lo, max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS hi FROM vals),
edge AS (SELECT i::BIGINT AS bin, lo + i * ((hi - lo) / {bins}::DOUBLE) AS a, lo + (i + 1) * ((hi - lo) / {bins}::DOUBLE) AS b FROM span, range({bins}) r(i))
SELECT '{col}' AS column, bin, {R('a', digits)} AS bin_lo, {R('b', digits)} AS bin_hi,
       (SELECT count(*) FROM vals WHERE x >= a AND (x < b OR bin = {bins - 1})) AS count
FROM edge
"""
