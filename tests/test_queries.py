"""A spread of registered queries against their oracles at the smallest scale.

All of them: python tests/run_oracles.py /root/testdata/sf0.01
"""

import os

import __spark_entry__ as entry
import harness
import pytest
from claimlens.operators import summary
from claimlens.plans import queries_graph, testbed
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NAMES = [
    "stage_claims", "claims_summary", "hcpcs_mix", "specialty_benchmarks", "feature_mart", "jsd_vs_specialty",
    "zip_entropy", "billing_velocity", "final_labels", "audit_report", "graph_clustering", "graph_pagerank",
    "graph_degrees", "graph_score", "audit_sample", "audit_name_rules", "token_set_similarity", "review_log",
    "risk_table", "average_precision", "lift_at_pct", "specialty_risk", "flatten_registry", "partition_load",
]


@pytest.fixture(scope="module")
def duck():
    return harness.connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    assert harness.difference(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) == ""


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_edges_are_stored_by_provider(spark):
    """Degrees, ranks and communities group the stored edges without another shuffle."""
    assert "Exchange" not in plan_of(queries_graph.edges(spark, SF).groupBy("npi").agg(F.count("hcpcs_code")))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_claim_lines_are_joined_without_sorting_them(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        plan = plan_of(testbed.claims(spark, SF))
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        # lookup tables above the broadcast limit are joined by sorting, the orders of the lines still by hashing
        spark.conf.set(key, "-1")
        assert "ShuffledHashJoin [l_orderkey" in plan_of(testbed.claims(spark, SF))
    finally:
        spark.conf.set(key, before)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_the_suite_checks_the_tables_of_the_mart(spark, monkeypatch):
    """Provider summary and benchmarks are worked out once, for the mart and its constraints."""
    calls = []
    for name in ("claims_summary", "specialty_benchmarks"):
        real = getattr(summary, name)
        monkeypatch.setattr(summary, name, lambda *a, real=real, name=name: calls.append(name) or real(*a))
    queries_graph.suite_tables(spark, SF)
    assert sorted(calls) == ["claims_summary", "specialty_benchmarks"]
