"""Physical-plan properties that matter at scale: pruning, pushdown, no
cartesian products, no Python in the hot path."""

import re

import pytest

from ledgerlake.config import scratch_path
from ledgerlake.operators import kpis, reports, score
from ledgerlake.plans.queries import canonical_fact
from ledgerlake.sources.tables import read_table, write_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fact_path(spark):
    path = scratch_path(spark, "plan-fact")
    write_table(canonical_fact(spark, SF), path, partition_by=("txn_date",))
    return path


def _plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_date_predicate_prunes_partitions(spark, fact_path):
    from pyspark.sql import functions as F

    df = read_table(spark, fact_path).filter(F.col("txn_date") == F.lit("2024-01-15").cast("date"))
    plan = _plan(df)
    assert re.search(r"PartitionFilters: \[isnotnull\(txn_date\), \(txn_date = 2024-01-15\)\]", plan), plan


def test_indicator_filters_reach_the_scan_and_prune_columns(spark, fact_path):
    fact = read_table(spark, fact_path)
    df = kpis.kpi_kyc_pending(fact)
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    meta = scan.metadata()
    pushed, schema = meta.get("PushedFilters").get(), meta.get("ReadSchema").get()
    assert "EqualTo(kyc_status,PENDING)" in pushed and "GreaterThan(daily_total_amount" in pushed, pushed
    assert "rolling_7day_amount" not in schema and "previous_ip_city" not in schema, schema


def test_score_has_no_cartesian_product(spark, fact_path):
    plan = _plan(score.system_risk_score(score.kpi_percentages(read_table(spark, fact_path))))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_python_in_any_plan(spark, fact_path):
    fact = read_table(spark, fact_path)
    for df in (canonical_fact(spark, SF), kpis.kpi_rapid_distribution(fact), kpis.kpi_impossible_travel(fact),
               reports.report_daily_pivot(reports.report_daily(fact))):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_fact_rows_shuffled_once(spark):
    plan = _plan(canonical_fact(spark, SF))
    fact_exchanges = re.findall(r"Exchange hashpartitioning\(customer_id, __seg, \d+\), REPARTITION_BY_COL", plan)
    # one for the fact rows plus one per table joined back (customers and four
    # summaries, all pinned to the same keys)
    assert len(fact_exchanges) == 6, fact_exchanges


def test_joins_with_fact_sized_sides_can_spill(spark):
    """A shuffled hash join holds its build side in memory; a sort-merge join spills."""
    assert "ShuffledHashJoin" not in _plan(canonical_fact(spark, SF))


def test_shuffle_width_is_left_to_the_deployment():
    from ledgerlake.config import session_settings

    assert "spark.sql.shuffle.partitions" not in session_settings()
