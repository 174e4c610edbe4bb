"""Streaming DAU equals batch DAU for every day the watermark has closed."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def run_to_memory(df, name, checkpoint, mode="append"):
    """Run a streaming frame into an in-memory table until its input is used up."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_dau_stream_matches_batch(spark):
    from cohortlab.operators.kpi import active_users
    from cohortlab.sources.schema import EVENTS_SCHEMA
    from cohortlab.sources.testdata import clickstream
    from cohortlab.streaming.incremental import dau_stream, read_events_stream

    t = clickstream(spark, SF)
    events = t.events.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS_SCHEMA.fields])
    base = tempfile.mkdtemp(prefix="cohortlab-stream-", dir="/tmp")
    src = os.path.join(base, "events")
    # files arrive in time order (one write per 5-day slice), one per trigger
    import time

    lo = events.agg(F.min("event_date")).first()[0]
    for k in range(7):
        part = events.filter((F.datediff("event_date", F.lit(lo)) >= 5 * k) & (F.datediff("event_date", F.lit(lo)) < 5 * (k + 1)))
        part.coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)

    stream = read_events_stream(spark, src, max_files_per_trigger=1)
    run_to_memory(dau_stream(stream, lateness="1 day"), "dau_stream_test", os.path.join(base, "ckpt"))
    got = {r["event_date"]: r["dau"] for r in spark.table("dau_stream_test").collect()}
    want = {r["event_date"]: r["dau"] for r in active_users(events, "day").collect()}
    assert got, "no day was closed by the watermark"
    assert {d: got[d] for d in got} == {d: want[d] for d in got}
    # every day except the ones still open at the end of input is emitted
    last = max(want)
    assert set(want) - set(got) <= {last - __import__("datetime").timedelta(days=i) for i in range(2)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_ingest_stream_appends_partitioned_table(spark):
    from cohortlab.sources.schema import EVENTS_SCHEMA
    from cohortlab.sources.testdata import clickstream
    from cohortlab.streaming.incremental import ingest_stream, read_events_stream

    t = clickstream(spark, SF)
    events = t.events.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS_SCHEMA.fields])
    base = tempfile.mkdtemp(prefix="cohortlab-ingest-", dir="/tmp")
    src = os.path.join(base, "in")
    events.write.parquet(src)
    q = ingest_stream(read_events_stream(spark, src), os.path.join(base, "out"), os.path.join(base, "ckpt"), trigger_once=True)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    assert out.count() == events.count()
    assert "event_month" in out.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_abandonment_stream_matches_batch(spark):
    import time

    from cohortlab.operators.funnel import abandonment
    from cohortlab.sources.schema import EVENTS_SCHEMA
    from cohortlab.sources.testdata import clickstream
    from cohortlab.streaming.incremental import abandoned_sessions_stream, read_events_stream

    t = clickstream(spark, SF)
    events = t.events.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS_SCHEMA.fields])
    base = tempfile.mkdtemp(prefix="cohortlab-sess-", dir="/tmp")
    src = os.path.join(base, "events")
    lo = events.agg(F.min("event_date")).first()[0]
    for k in range(7):
        part = events.filter((F.datediff("event_date", F.lit(lo)) >= 5 * k) & (F.datediff("event_date", F.lit(lo)) < 5 * (k + 1)))
        part.coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = read_events_stream(spark, src, max_files_per_trigger=1)
    run_to_memory(abandoned_sessions_stream(stream, gap="1 day", lateness="1 day"), "abandon_stream_test", os.path.join(base, "ckpt"))
    got = spark.table("abandon_stream_test")
    closed = [r["session_id"] for r in got.select("session_id").collect()]
    assert closed, "no session closed"
    # batch U5 restricted to the sessions the stream has closed
    batch = abandonment(events.join(spark.createDataFrame([(s,) for s in closed], "session_id string"), "session_id"))
    want = {r["last_event_reached"]: r["session_count"] for r in batch.collect()}
    have = {r["last_event_reached"]: r["n"] for r in got.groupBy("last_event_reached").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert have == want
