"""Plans and results under the conditions of large data: no broadcasts, hot keys, re-run tasks."""

import os

import pytest
from oracle_check import connect, difference
from pyspark.sql import functions as F

from claimloom import session
from claimloom.oracles import ORACLES
from claimloom.plans import classifier, reports, warehouse
from claimloom.queries import QUERIES
from claimloom.sources.sample_tables import AS_OF, SampleTables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test."""
    changed = []

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            changed.append(key)
            spark.conf.set(key, value)

    yield change
    for key in changed:
        spark.conf.unset(key)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize(
    "name",
    ["kpis", "loss_ratio", "quality_checks", "missing_refs", "q2_month_trend", "monthly_region", "surrogate_keys", "high_cost_labels", "derive_members"],
)
def test_same_results_without_broadcast_joins(spark, settings, name):
    settings(**NO_BROADCAST)
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def hot_claims(spark):
    """Sample claims with a third of the rows moved to one member and one provider."""
    t = SampleTables(spark, FOLDER)
    hot = F.crc32(F.col("claim_id")) % 3 == 0
    claims = t.claims().withColumns(
        {c: F.when(hot, F.lit(7).cast("bigint")).otherwise(F.col(c)) for c in ("member_id", "provider_id")}
    )
    return claims.repartition(16), t


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_member_is_split(spark, settings, rows):
    claims, t = hot_claims(spark)
    expected = rows(reports.kpis(reports.claim_measures(reports.joined_claims(claims, t.members(), t.providers(), AS_OF))))
    settings(
        **NO_BROADCAST,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8192",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8192",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
    )
    report = reports.kpis(reports.claim_measures(reports.joined_claims(claims, t.members(), t.providers(), AS_OF)))
    assert "SortMergeJoin(skew=true)" in final_plan(report)
    assert rows(report) == expected


def test_hot_member_with_adaptive_execution_off(spark, settings, rows):
    claims, t = hot_claims(spark)
    expected = rows(classifier.member_cost(claims, t.members(), t.providers()))
    settings(**NO_BROADCAST, spark__sql__adaptive__enabled="false")
    assert rows(classifier.member_cost(claims, t.members(), t.providers())) == expected


def test_claims_are_summed_before_they_meet_the_members(spark):
    claims, t = hot_claims(spark)
    plan = classifier.member_cost(claims, t.members(), t.providers())._jdf.queryExecution().optimizedPlan().toString()
    # In the printed tree the outer join comes first: the sums lie below it.
    assert plan.index("Join Inner, (member_id") < plan.index("Aggregate [member_id")


LAZY = [
    n
    for n in QUERIES
    if n
    not in {
        "surrogate_keys", "serial_claim_ids", "ingest_feed", "high_cost_threshold", "high_cost_labels", "class_balance",
        "split_balance", "classifier_accuracy", "profile", "synthetic_claims", "ingest_files", "ingest_without_ids",
        "reference_errors", "csv_with_column", "warehouse_tables", "q1_stored", "q3_stored", "gate_failures", "quality_report",
        "report_files", "classifier_fit", "classifier_fallbacks", "cube_reports",
    }
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def test_report_reads_only_its_columns(spark):
    plan = QUERIES["network_summary"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "part.parquet" not in plan
    assert "l_shipdate" not in plan and "l_linestatus" not in plan
    # one for the sums per member, one for the report; claim rows themselves are not shuffled
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["kpis", "monthly", "loss_ratio", "network_summary", "q1_age_region", "class_means"])
def test_reports_sum_before_they_meet_the_members(spark, settings, name):
    settings(**NO_BROADCAST)
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [i for i, line in enumerate(plan) if "Join Inner" in line]
    sums = [i for i, line in enumerate(plan) if "Aggregate [" in line]
    assert sums[0] < joins[0] < sums[1]  # as the tree is printed: the report, the member join, the sums per member


def test_fact_is_written_in_balanced_partitions(spark):
    claims, t = hot_claims(spark)
    plan = warehouse.partitioned_fact(warehouse.fact_claims(claims))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_staging_scope_cleans_up(spark):
    with session.staging_scope(spark):
        path = session.stage(spark.range(3), "t").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_partitions_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_for(spark, 10 * 1000**4) as wanted:
        assert wanted == 7450
    with session.sized_for(spark, 100 * 1000**4) as wanted:
        assert wanted == 74_505
    with session.sized_for(spark, 1000) as wanted:
        assert wanted == int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
