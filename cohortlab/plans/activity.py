"""Activity as one bitmap of days per user.

``activity_bitmap`` reduces events to a row per user: ``words``, 64 days each,
counted from ``base``.  Every word is one ``bit_or`` of the same aggregate, so
a user's days are merged in the map tasks and one shuffle by user builds the
table, a few dozen bytes a user.  Day-N flags, the retention curve and monthly
cohorts are then bit tests on the row of the user: no distinct, no exploded
days, no further shuffle of activity.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spans of more words (22 years) are merged word by word instead, which
#: takes a second aggregate: the aggregate's width stays bounded.
MAX_WORDS = 128


def is_activity_bitmap(df: DataFrame) -> bool:
    """True for the table built by :func:`activity_bitmap`."""
    return "_activity_bitmap" in df.columns


def activity_bitmap(events: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """(user_id, base, words): bit ``d % 64`` of ``words[d / 64]`` is set if
    the user has an event ``d`` days after ``base``.

    ``first`` and ``last`` bound the days of ``events`` (from partition names
    or a manifest, say); without them one aggregate finds them.  Days beyond
    given bounds are not represented.  Events without a date leave the user's
    row without that bit.  No events: an empty table."""
    if first is None or last is None:
        found = events.agg(F.min("event_date"), F.max("event_date")).first()
        first, last = first or found[0] or dt.date(1970, 1, 1), last or found[1] or dt.date(1970, 1, 1)
    n = (last - first).days // 64 + 1
    day = F.datediff("event_date", F.lit(first))
    inside = day.between(0, (last - first).days)
    days = events.select("user_id", F.when(inside, F.floor(day / 64).cast("int")).alias("_w"), F.when(inside, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(64)))).alias("_b"))
    zero = F.lit(0).cast("long")
    if n <= MAX_WORDS:
        per = days.groupBy("user_id").agg(*[F.coalesce(F.bit_or(F.when(F.col("_w") == i, F.col("_b"))), zero).alias(f"_{i}") for i in range(n)])
        per = per.select("user_id", F.array(*[f"_{i}" for i in range(n)]).alias("words"))
    else:
        each = days.groupBy("user_id", "_w").agg(F.bit_or("_b").alias("_b"))
        entries = F.collect_list(F.when(F.col("_w").isNotNull(), F.struct("_w", "_b")))
        per = each.groupBy("user_id").agg(F.map_from_entries(entries).alias("_m"))
        words = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), zero))
        per = per.select("user_id", words.alias("words"))
    return per.select("user_id", F.lit(first).alias("base"), "words", F.lit(1).alias("_activity_bitmap"))


def active_on(day: Column) -> Column:
    """Whether the bitmap of the row has ``day`` (a number of days after its
    base; any number)."""
    word = F.get("words", F.floor(day / 64).cast("int"))
    bit = word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(64)).cast("int")))
    return F.coalesce((day >= 0) & (bit != 0), F.lit(False))


def bits_from(day: Column) -> Column:
    """The 64 days from ``day`` (a number of days after the base) on as the
    bits of one number."""
    at, shift = F.floor(day / 64).cast("int"), F.pmod(day, F.lit(64)).cast("int")
    zero = F.lit(0).cast("long")
    low, high = (F.coalesce(F.get("words", at + i), zero) for i in (0, 1))
    both = F.call_function("shiftrightunsigned", low, shift).bitwiseOR(F.call_function("shiftleft", high, F.lit(64) - shift))
    return F.coalesce(F.when(shift == 0, low).otherwise(both), zero)


def months_of(bitmap: DataFrame) -> tuple[dt.date | None, int]:
    """Base and number of words of a bitmap table (one row is read)."""
    row = bitmap.select("base", F.size("words").alias("n")).first()
    return (row["base"], row["n"]) if row else (None, 0)


def active_months(base: dt.date, n_words: int) -> Column:
    """Month indexes (year * 12 + month) in which the row's bitmap has a day:
    a test of at most two words for each month of the span."""
    out, day, end = [], base, base + dt.timedelta(days=64 * n_words)
    while day < end:
        after = dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)
        a, b = (day - base).days, min((after - base).days, 64 * n_words)
        hit = F.lit(False)
        for w in range(a // 64, (b - 1) // 64 + 1):
            lo, hi = max(a - 64 * w, 0), min(b - 64 * w, 64)
            mask = ((1 << hi) - 1) ^ ((1 << lo) - 1)
            mask -= (1 << 64) if mask >> 63 else 0
            hit = hit | (F.get("words", F.lit(w)).bitwiseAND(F.lit(mask).cast("long")) != 0)
        out.append(F.when(hit, F.lit(day.year * 12 + day.month).cast("long")))
        day = after
    return F.array_compact(F.array(*out))
