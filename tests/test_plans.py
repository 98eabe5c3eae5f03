"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["spend_vs_visits", "spend_vs_visits_fanout",
                                  "spend_vs_visits_region_fanout", "visit_summary",
                                  "zero_fill_visits", "dedup_best_record", "budget_compliance"])
def test_no_nested_loop_or_cartesian(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in p
    assert "CartesianProduct" not in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    from spendlens.plans import bindings as B
    df = B.ads_fact(spark, SF).filter(F.col("date") >= F.lit("1998-01-01").cast("date")) \
        .select("campaign_id", "spend_usd")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    assert "l_tax" not in p and "l_linestatus" not in p     # unused columns not read


def test_dedup_uses_partial_aggregation(spark):
    p = _plan(E.queries()["dedup_best_record"](spark, SF))
    assert "partial_max(struct(" in p
    assert "Window" not in p
