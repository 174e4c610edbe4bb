"""Oracle SQL — funnel (U1–U6): stages are conditions on one row per user."""

from sql_oracle.bindings import HAS, PCT, PEOPLE, R

#: Stage names in order and who reached them; events of unknown users count in the totals.
_STAGES = ["signup", "search_started", "booking_started", "booking_completed"]

_REACHED = """
reached AS (
    SELECT i, stage, CASE WHEN i = 1 THEN (SELECT count(*) FROM app_users)
                          ELSE (SELECT count(DISTINCT user_id) FROM app_events WHERE event_name = stage) END AS n
    FROM (SELECT unnest(range(1, 5)) AS i, unnest(['signup', 'search_started', 'booking_started', 'booking_completed']) AS stage)
)"""

U1 = _REACHED + "\nSELECT stage AS funnel_stage, n AS users_reached FROM reached"

U2 = (
    _REACHED
    + f"""
SELECT here.stage, here.n AS users_reached, {R(PCT('here.n', 'top.n'), 1)} AS pct_of_top_of_funnel,
       {R(PCT('here.n', 'before.n'), 1)} AS pct_of_previous_stage, {R(PCT('before.n - here.n', 'before.n'), 1)} AS drop_off_pct_vs_previous
FROM reached here JOIN reached top ON top.i = 1 LEFT JOIN reached before ON before.i = here.i - 1
"""
)


#: The same for the iOS users: conditions on their rows only.
_IOS = [f"count_if({HAS(s)})" if s != "signup" else "count(*)" for s in _STAGES]
U2_IOS = f"""{PEOPLE},
reached AS (
    SELECT unnest(range(1, 5)) AS i, unnest({_STAGES!r}) AS stage, unnest([{', '.join(_IOS)}]) AS n FROM person WHERE platform = 'iOS'
)
""" + U2[U2.index("SELECT here.stage"):]


def U3(dim: str) -> str:
    counts = ["count(*)", *[f"count_if({HAS(s)})" for s in _STAGES[1:]]]
    rows = []
    for i, stage in enumerate(_STAGES):
        before = f"k{i - 1}" if i else "NULL::BIGINT"
        rows.append(
            f"SELECT d AS {dim}, '{stage}' AS stage, {i + 1} AS stage_order, k{i}::BIGINT AS users, {R(PCT(f'k{i}', 'k0'), 2)} AS pct_of_signups, "
            f"{R(PCT(f'k{i}', before), 2)} AS pct_of_previous_stage, {R('100.0 - ' + PCT(f'k{i}', before), 2)} AS drop_off_pct FROM wide"
        )
    wide = ", ".join(f"{c} AS k{i}" for i, c in enumerate(counts))
    return f"{PEOPLE},\nwide AS (SELECT {dim} AS d, {wide} FROM person GROUP BY 1)\n" + "\nUNION ALL\n".join(rows)


U4 = f"""
tally AS (SELECT map_from_entries(list((event_name, n))) AS m FROM (SELECT event_name, count(*) AS n FROM app_events GROUP BY 1)),
named AS (
    SELECT coalesce(m['booking_started'], 0) AS booking_attempts, coalesce(m['booking_completed'], 0) AS completed,
           coalesce(m['booking_cancelled'], 0) AS cancelled, coalesce(m['payment_failed'], 0) AS payment_failed FROM tally
)
SELECT *, {R(PCT('cancelled', 'booking_attempts'), 1)} AS cancellation_rate_pct, {R(PCT('completed', 'booking_attempts'), 1)} AS booking_completion_rate_pct
FROM named
"""

#: Last event of a session: the latest; of several at that time the one whose name comes last.
U5 = f"""
ended AS (
    SELECT session_id, arg_max(event_name, (event_time, event_name)) AS last_event_reached FROM app_events
    GROUP BY session_id HAVING bool_or(event_name = 'search_started') AND NOT bool_or(event_name = 'booking_completed')
)
SELECT last_event_reached, count(*) AS session_count, {R(PCT('count(*)', 'sum(count(*)) OVER ()'), 1)} AS pct_of_non_converting_sessions
FROM ended GROUP BY last_event_reached
"""


def U6(dim: str = "acquisition_channel") -> str:
    return f"""{PEOPLE},
steps AS (
    SELECT {dim}, count(*) AS signups, count_if({HAS('search_started')})::BIGINT AS searched,
           count_if({HAS('booking_started')})::BIGINT AS booking_started, count_if({HAS('booking_completed')})::BIGINT AS booked
    FROM person GROUP BY ALL
)
SELECT *, {R(PCT('searched', 'signups'), 1)} AS search_rate_pct, {R(PCT('booking_started', 'searched'), 1)} AS booking_start_rate_pct,
       {R(PCT('booked', 'booking_started'), 1)} AS booking_completion_rate_pct, {R(PCT('booked', 'signups'), 1)} AS overall_conversion_pct
FROM steps
"""
