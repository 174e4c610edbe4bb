"""Oracle SQL — feature adoption (A1–A5): conditions on one row per user."""

from sql_oracle.bindings import BACK, HAS, PCT, PEOPLE, R, SHARE

_FEATURES = ["notification_enabled", "favourite_location_added", "promo_viewed"]
_PAYS = HAS("booking_completed")

A1 = f"""
SELECT feature, count(DISTINCT e.user_id) AS adopters, {R(PCT('count(DISTINCT e.user_id)', '(SELECT count(*) FROM app_users)'), 1)} AS adoption_rate_pct
FROM (SELECT unnest({_FEATURES!r}) AS feature) f LEFT JOIN app_events e ON e.event_name = feature GROUP BY feature
"""


def A2(days=(7, 30)):
    rates = ", ".join(f"{SHARE(BACK(d))} AS day{d}_retention_pct" for d in days)
    return f"""{PEOPLE}
SELECT feature, CASE WHEN list_contains(names, feature) THEN 'Adopters' ELSE 'Non-adopters' END AS segment, count(*) AS users,
       {rates}, {SHARE(_PAYS)} AS conversion_rate_pct
FROM person, (SELECT unnest({_FEATURES!r}) AS feature) GROUP BY ALL
"""


def A3(dim="platform"):
    labels = ["notification_adoption_pct", "favourite_adoption_pct", "promo_view_adoption_pct"]
    return f"{PEOPLE}\nSELECT {dim}, count(*) AS total_users, " + ", ".join(f"{SHARE(HAS(f))} AS {n}" for f, n in zip(_FEATURES, labels)) + " FROM person GROUP BY ALL"


def A4(day=30):
    return f"""{PEOPLE}
SELECT len(list_intersect(names, {_FEATURES!r}))::BIGINT AS features_adopted, count(*) AS users, {SHARE(BACK(day))} AS day{day}_retention_pct
FROM person GROUP BY 1
"""


def _rate(wanted: str) -> str:
    return f"(100.0 * count_if({_PAYS} AND {wanted}) / nullif(count_if({wanted}), 0))"


_WITH, _WITHOUT = _rate("list_contains(names, feature)"), _rate("NOT list_contains(names, feature)")
A5 = f"""{PEOPLE}
SELECT feature, {R(_WITH, 1)} AS adopter_conversion_pct, {R(_WITHOUT, 1)} AS non_adopter_conversion_pct, {R(f'{_WITH} - {_WITHOUT}', 1)} AS uplift_pp
FROM person, (SELECT unnest({_FEATURES[:2]!r}) AS feature) GROUP BY feature
"""
