import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("cohortlab-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlab-test-ckpt-", dir="/tmp"))
    yield s


D = dt.date
TS = dt.datetime


def users_df(spark, rows):
    """rows: (user_id, signup_date, country, platform, channel, age_group, group, first_device)."""
    from cohortlab.sources.schema import USERS_SCHEMA

    full = [(u, s, c, "City", p, ch, a, g, f) for (u, s, c, p, ch, a, g, f) in rows]
    return spark.createDataFrame(full, USERS_SCHEMA)


def events_df(spark, rows):
    """rows: (event_id, user_id, event_time, session_id, event_name, revenue)."""
    from cohortlab.sources.schema import EVENT_PRODUCT_AREA, EVENTS_SCHEMA

    full = [
        (e, u, t, t.date(), s, n, EVENT_PRODUCT_AREA.get(n, "Engagement"), "iOS", r, None, None)
        for (e, u, t, s, n, r) in rows
    ]
    return spark.createDataFrame(full, EVENTS_SCHEMA)
