"""Structured Streaming forms of batch operators.

* :func:`dau_stream` — K8 (daily active users) maintained incrementally.
  Two chained event-time window aggregations: (day, user) → one row per
  active user-day, then users per day.  The watermark bounds the state of
  both: a day is final and emitted (append mode) once the watermark passes
  its end, after which its state is dropped.
* :func:`ingest_stream` — append new events to the month-partitioned
  Parquet table read by the batch operators (IO2 as a stream), exactly once
  through the query's checkpoint.

Days are UTC calendar days (the session time zone is pinned to UTC), so a
day window equals ``event_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlab.sources.schema import EVENTS_SCHEMA


def read_events_stream(spark: SparkSession, path: str, schema=EVENTS_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream new Parquet files of events from ``path`` (explicit schema)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def dau_stream(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Daily active users of a streaming events frame.

    Output columns: ``event_date``, ``dau`` — the same as the batch
    ``active_users(events, "day")`` for every day the watermark has closed.
    Events later than ``lateness`` behind the newest event time are dropped.
    """
    wm = events.withWatermark("event_time", lateness)
    per_user_day = wm.groupBy(F.window("event_time", "1 day").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("_n"))
    per_day = per_user_day.groupBy(F.window(F.window_time("day"), "1 day").alias("d")).agg(F.count(F.lit(1)).alias("dau"))
    return per_day.select(F.to_date(F.col("d.start")).alias("event_date"), "dau")


def ingest_stream(events: DataFrame, out_path: str, checkpoint: str, trigger_once: bool = False) -> StreamingQuery:
    """Append a stream of canonical events to a month-partitioned Parquet table.

    ``checkpoint`` must be a shared (distributed) folder on a cluster; it
    holds the source offsets and sink commit log that make the append
    exactly-once across restarts and lost executors.
    """
    out = events.withColumn("event_month", F.date_format("event_date", "yyyy-MM"))
    writer = (
        out.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_month")
        .outputMode("append")
    )
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def abandoned_sessions_stream(events: DataFrame, gap: str = "1 day", lateness: str = "1 day", start: str = "search_started", goal: str = "booking_completed") -> DataFrame:
    """U5 per session, incrementally: sessions that fired ``start`` but never
    ``goal``, with the last event reached (latest (event_time, event_name)).

    Events are grouped by ``session_id`` and an event-time ``session_window``
    (a session closes after ``gap`` without events); the watermark bounds the
    state and the session row is emitted once it has closed (append mode).
    Counting the emitted rows per ``last_event_reached`` gives the batch
    abandonment table for the closed sessions.  Unlike the batch rule, a
    session that pauses for longer than ``gap`` is reported once per part:
    choose a ``gap`` beyond the longest pause.
    """
    name = F.col("event_name")
    per_session = (
        events.withWatermark("event_time", lateness)
        .groupBy("session_id", F.session_window("event_time", gap).alias("w"))
        .agg(
            F.max(F.when(name == start, 1).otherwise(0)).alias("_start"),
            F.max(F.when(name == goal, 1).otherwise(0)).alias("_goal"),
            F.max(F.struct("event_time", "event_name"))["event_name"].alias("last_event_reached"),
        )
    )
    return per_session.filter((F.col("_start") == 1) & (F.col("_goal") == 0)).select(
        "session_id",
        F.col("w.start").alias("session_start"),
        F.col("w.end").alias("session_end"),
        "last_event_reached",
    )
