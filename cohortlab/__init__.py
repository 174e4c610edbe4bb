"""cohortlab — product-analytics operators (KPIs, funnels, retention, cohorts,
feature adoption, segmentation, A/B readouts, data quality) written as plain
PySpark DataFrame functions.

Every operator takes DataFrames in the canonical ``users`` / ``events`` /
``experiments`` model (see :mod:`cohortlab.sources.schema`) plus parameters
and returns a DataFrame.  Nothing is collected inside an operator.
"""

from cohortlab.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
