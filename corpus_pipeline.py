"""A corpus cleaning pipeline of five training-data operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
with ``docs`` the rows its predecessor kept, and returns a DataFrame with the
columns of documents (the last one adds ``copy``).  ``run`` applies them one
after the other and writes the rows between stages to the shared checkpoint
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from cohortlab.llm.common import id_remainder, saved, table

#: The toxicity model and the seeded mix have no SQL form.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject.  It learns from
    the labelled rows whose crc32(doc_id) mod 4 is not 2."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2)
    return toxicity.score(docs, model).filter("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier line; ``n_chars``
    is that of the new text."""
    cleaned = line_dedup.remove_duplicate_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs).select(docs.columns)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their sources ask."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_texts),
    ("mixing sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
