"""Sources and sinks (CSV / Parquet) for the canonical tables.

* :func:`load_tables`   — read the three tables with explicit schemas.
* :func:`ingest_csv`    — CSV → typed Parquet (``converted`` cast to boolean,
                          events partitioned by ``event_date`` for pruning);
                          returns the written row counts via ``observe``.
* :func:`read_csv_checked`, :func:`ingest_csv_checked` — the same, with rows
                          that don't fit the schema set aside and explained.
* :func:`publish_tables`, :func:`load_published` — atomic rebuild and read.
* :func:`write_csv`     — CSV sink with a header.
"""

from __future__ import annotations

import os
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.sources.schema import EVENTS_SCHEMA, SCHEMAS, USERS_SCHEMA, Tables
from cohortlab.sources.versions import VersionedTable

TABLES = ("users", "events", "experiments")


# Text tokens a pandas CSV reader treats as missing by default.
PANDAS_MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv_table(spark: SparkSession, path: str, name: str, none_is_null: bool = True) -> DataFrame:
    """Read one canonical table from CSV with its explicit schema.

    The source system loads its CSVs with pandas, whose default missing-value
    tokens (``NA``, ``NaN``, ...) stand for a missing value in any column; so
    does the text ``"None"`` (a legal payment method).  ``none_is_null=False``
    keeps such tokens as text in text columns.  Integers with gaps are written
    as floats ("12.0") and ``converted`` as True/False.  Any other text that is
    no value of its column's type fails the read."""
    schema = SCHEMAS[name]
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    df = spark.read.schema(text).option("header", True).option("mode", "FAILFAST").csv(path)
    cols = []
    for f in schema.fields:
        is_text = isinstance(f.dataType, T.StringType) and f.name != "converted"
        c = F.col(f.name)
        if none_is_null or not is_text:
            c = F.when(~c.isin(*PANDAS_MISSING_TOKENS), c)
        if f.name == "converted":
            c = F.lower(c).isin("true", "1", "1.0")
        elif isinstance(f.dataType, (T.IntegerType, T.LongType)):
            c = c.cast("double").cast(f.dataType)
        elif isinstance(f.dataType, T.DateType):
            c = F.to_date(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.to_timestamp(c, "yyyy-MM-dd HH:mm:ss").cast(f.dataType)
        elif not is_text:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


class CheckedRows(NamedTuple):
    """Rows of a CSV that fit the schema, and what is wrong with the others."""

    good: DataFrame
    rejects: DataFrame


_MALFORMED = "__malformed"


def _checked(f: T.StructField, none_is_null: bool):
    """(value or null, reason or null) of one text cell."""
    is_text = isinstance(f.dataType, T.StringType) and f.name != "converted"
    cell = F.col(f"`{f.name}`")
    if none_is_null or not is_text:
        cell = F.when(~cell.isin(*PANDAS_MISSING_TOKENS), cell)
    if is_text:
        return cell, F.lit(None).cast("string")
    if f.name == "converted":
        said = F.lower(cell)
        value, reason = F.when(said.isin("true", "1", "1.0"), True).when(said.isin("false", "0", "0.0"), False), "not a boolean"
        if none_is_null:  # the strict reader takes a missing flag as false
            value = F.when(cell.isNull(), False).otherwise(value)
    elif isinstance(f.dataType, (T.IntegerType, T.LongType)):
        number = cell.try_cast("double")
        value, reason = F.coalesce(cell.try_cast(f.dataType), F.when(number == F.floor(number), number.try_cast(f.dataType))), "not an integer"
    elif isinstance(f.dataType, T.DateType):
        value, reason = F.try_to_date(cell, "yyyy-MM-dd"), "not a date"
    elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        value, reason = F.try_to_timestamp(cell, F.lit("yyyy-MM-dd HH:mm:ss")).cast(f.dataType), "not a timestamp"
    else:
        value, reason = cell.try_cast(f.dataType), "not a number"
    return value, F.when(cell.isNotNull() & value.isNull(), F.lit(reason))


def read_csv_checked(spark: SparkSession, path: str, name: str, none_is_null: bool = True, max_bad_share: float | None = None) -> CheckedRows:
    """Read one canonical table from CSV and keep going over bad rows.

    ``good`` has the rows whose every cell is missing or a value of its
    column's type, like :func:`read_csv_table`.  ``rejects`` has a row per bad
    cell of the others: table_name, column_name, value, reason and raw (the
    row as CSV); a line with too many or too few cells has one row without a
    column, with the line as it is.  A row is in exactly one of the two.  With
    ``max_bad_share`` the load fails if a larger share of rows is rejected."""
    schema = SCHEMAS[name]
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields] + [T.StructField(_MALFORMED, T.StringType(), True)])
    # whole lines are parsed whatever is read of them: a line is malformed for every reader or for none
    rows = spark.read.schema(text).option("header", True).option("columnPruning", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _MALFORMED).csv(path)
    cells = [(f.name, *_checked(f, none_is_null)) for f in schema.fields]
    faults = F.array(*[F.when(reason.isNotNull(), F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value"), reason.alias("reason"))) for c, _, reason in cells])
    line = F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("value"), F.lit("malformed line").alias("reason"))
    bad = F.when(F.col(_MALFORMED).isNotNull(), F.array(line)).otherwise(F.array_compact(faults))
    judged = rows.withColumn("__bad", bad)
    if max_bad_share is not None:
        n, lost = judged.agg(F.count(F.lit(1)), F.count_if(F.size("__bad") > 0)).first()
        if lost > max_bad_share * n:
            raise ValueError(f"{path}: {lost} of {n} rows rejected, at most {max_bad_share:.2%} are allowed")
    good = judged.filter(F.size("__bad") == 0).select(*[value.alias(c) for c, value, _ in cells])
    raw = F.coalesce(F.col(_MALFORMED), F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields])))
    rejects = judged.filter(F.size("__bad") > 0).select(F.lit(name).alias("table_name"), raw.alias("raw"), F.explode("__bad").alias("x"))
    return CheckedRows(good, rejects.select("table_name", "x.column_name", "x.value", "x.reason", "raw"))


def load_tables(spark: SparkSession, data_dir: str, fmt: str = "parquet", none_is_null: bool = True) -> Tables:
    """Load users / events / experiments from ``data_dir`` (parquet or csv)."""
    out = {}
    for name in TABLES:
        if fmt == "csv":
            out[name] = read_csv_table(spark, os.path.join(data_dir, f"{name}.csv"), name, none_is_null)
        else:
            schema = SCHEMAS[name]
            if name == "events":
                # expose the month partition column so range filters on it prune folders
                schema = T.StructType(schema.fields + [T.StructField("event_month", T.StringType(), True)])
            out[name] = spark.read.schema(schema).parquet(os.path.join(data_dir, name))
    return Tables(out["users"], out["events"], out["experiments"])


def write_table(df: DataFrame, path: str, name: str) -> dict:
    """Idempotent overwrite of one canonical table as Parquet; returns its row count.

    Events are partitioned by month so date filters prune whole folders.  They
    are rebalanced by month first: a small month is one file, and a month with
    a large share of the data is split by AQE into several tasks and files.
    """
    obs = Observation(f"rows_{name}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite")
    if name == "events":
        observed = observed.withColumn("event_month", F.date_format("event_date", "yyyy-MM"))
        writer = observed.hint("rebalance", "event_month").write.mode("overwrite").partitionBy("event_month")
    writer.parquet(path)
    return {name: obs.get.get("rows", 0)}


def publish_tables(tables: Tables, out_dir: str) -> dict[str, list[str]]:
    """Rebuild the three tables below ``out_dir`` as versioned tables (events
    by month): readers see the old rows until a table is complete, and months
    whose rows are the same are left alone.  Returns the parts that changed."""
    spark, changed = tables.users.sparkSession, {}
    for name in TABLES:
        part = F.date_format("event_date", "yyyy-MM") if name == "events" else None
        changed[name] = VersionedTable(spark, os.path.join(out_dir, name)).publish(getattr(tables, name), part)
    return changed


def load_published(spark: SparkSession, data_dir: str) -> Tables:
    """The tables as last published by :func:`publish_tables`."""
    return Tables(*[VersionedTable(spark, os.path.join(data_dir, name)).read() for name in TABLES])


def ingest_csv_checked(spark: SparkSession, csv_dir: str, out_dir: str, none_is_null: bool = True, max_bad_share: float = 0.01) -> dict:
    """Bulk-load the three CSV files into versioned tables; rows with a bad
    cell go to the versioned table ``rejects`` instead.  Nothing is published
    if more than ``max_bad_share`` of a file is rejected.  Returns rows
    published and cells rejected per table."""
    read = {n: read_csv_checked(spark, os.path.join(csv_dir, f"{n}.csv"), n, none_is_null, max_bad_share) for n in TABLES}
    publish_tables(Tables(*[read[n].good for n in TABLES]), out_dir)
    bad = read[TABLES[0]].rejects
    for name in TABLES[1:]:
        bad = bad.unionByName(read[name].rejects)
    rejects = VersionedTable(spark, os.path.join(out_dir, "rejects"))
    rejects.publish(bad, F.col("table_name"))
    rows = lambda table: sum(p["rows"] for p in table.manifest()["parts"].values())
    lost = rejects.manifest()["parts"]
    return {n: {"rows": rows(VersionedTable(spark, os.path.join(out_dir, n))), "rejected_cells": lost.get(n, {"rows": 0})["rows"]} for n in TABLES}


def ingest_csv(spark: SparkSession, csv_dir: str, out_dir: str, none_is_null: bool = True) -> dict:
    """Bulk-load the three CSV files into typed Parquet tables (drop and recreate)."""
    counts = {}
    for name in TABLES:
        df = read_csv_table(spark, os.path.join(csv_dir, f"{name}.csv"), name, none_is_null)
        counts.update(write_table(df, os.path.join(out_dir, name), name))
    return counts


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "user_id", buckets: int | None = None) -> DataFrame:
    """Store a dimension (normally ``users``) bucketed and sorted by ``key`` as
    an external table at ``path`` and return it read back.

    Joins of the bucketed table with per-user aggregates then shuffle only the
    aggregate side: Spark keeps the bucket layout and repartitions the other
    side to match.  ``buckets`` defaults to ``spark.sql.shuffle.partitions``."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(table)
    return spark.table(table)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header row (overwrites)."""
    df.write.mode("overwrite").option("header", True).csv(path)


__all__ = ["load_tables", "ingest_csv", "read_csv_checked", "ingest_csv_checked", "publish_tables", "load_published", "write_csv", "write_table", "read_csv_table", "USERS_SCHEMA", "EVENTS_SCHEMA"]
