"""Plan properties the design relies on: predicates and column pruning reach
the Parquet scans of the line aggregation."""

import os

import pytest

from audix.operators.rank import group_spend
from audix.plans import chains as K
from audix.plans import specs as S

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_predicates_and_pruning_reach_the_scans(spark):
    plan = _plan(group_spend(K.full_snapshot(spark, SF), S.pool_groups(spark, SF)))
    assert "EqualTo(p_type,ECONOMY)" in plan
    assert "In(p_brand, [Brand#1,Brand#2,Brand#3,Brand#4])" in plan
    line_schema = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_shipdate" not in line_schema and "l_tax" not in line_schema
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_week_range_bounds_the_scan(spark):
    plan = _plan(K.week_snapshot(spark, SF, S.TOPK_START_WEEK, S.TOPK_END_WEEK))
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "GreaterThanOrEqual(o_orderdate" in orders and "LessThan(o_orderdate" in orders


def test_picks_sort_no_whole_group(spark):
    from audix.operators.ranking import pick_by_rank
    df = spark.range(1000).selectExpr("id AS household_id", "cast(id + 1 AS int) AS rank")
    plan = _plan(pick_by_rank(df, [], 10, "rank", ["household_id"]))
    # Only the counts per range meet in one task; rows are joined to them and sorted by (group, range).
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1 and all("_rk_n" in lines[i + 1] for i in single)
    assert "BroadcastNestedLoopJoin" not in plan
