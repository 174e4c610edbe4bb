"""Fixtures and helpers of the operator tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(rows, schema=DOCS):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return build


def clashing(df, *names):
    """``df`` with extra columns that clash with an operator's own names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("mine") for n in names if n not in df.columns})
