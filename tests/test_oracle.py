"""Registered queries vs their DuckDB oracle on the driver's test tables.

By default a representative subset runs at sf0.001; set ``FULL_ORACLE=1`` to
run every registered query (``ORACLE_SF_DIR`` selects the folder).
"""

import os

import pytest

from oracle_harness import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

SUBSET = [
    "u2_funnel", "u3_funnel_by_channel", "u5_abandonment", "k2_users_by_age_group", "k9_wau_orders",
    "k11_stickiness", "k15_revenue_by_channel", "k17_exec_kpis_churn_orders", "t1_retention",
    "t3_retention_curve", "c3_cohort_matrix", "c4_cohort_revenue", "a2_adoption_effect", "a4_adoption_depth",
    "s2_value_tiers", "s3_top_segments", "s7_corr_matrix", "s8_describe_events", "s9_histogram_revenue",
    "x3_arm_arpu", "x5_ztest_pvalue", "x7_welch_revenue_pvalue", "x13_significance_label", "u2_funnel_subset", "k11_stickiness", "k22_channel_platform_mix", "c3_cohort_matrix", "c4_cohort_revenue", "dq3_full_row_duplicates", "dq17_schema_report", "io5_experiments", "x6_mean_ztest_orders", "x7_welch_revenue", "x10_time_to_conversion_orders",
    "dq9_null_rates_events", "dq11_domain_violations_all", "dq19_validation_report",
]


def _names():
    import __spark_entry__ as E

    if os.environ.get("FULL_ORACLE"):
        return list(E.queries())
    return SUBSET


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF_DIR, con)
    assert ok, msg


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from registry import REGISTRY

    assert {n for n in REGISTRY if n not in E.oracle_sql()} == set()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["stage", "users_reached", "pct_of_top_of_funnel", "pct_of_previous_stage", "drop_off_pct_vs_previous"]
    assert df.count() == 4
