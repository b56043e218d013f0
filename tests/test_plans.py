"""Plan shape: the properties that matter at scale, read off the physical plan."""

import re

from conftest import SF001
from stockledger.plans.catalog import queries

Q = queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _tree(plan: str) -> str:
    return plan.split("\n\n")[0]


def test_interval_plan_two_shuffles_one_window_no_join(spark):
    plan = _formatted(Q["interval_stock"](spark, SF001))
    tree = _tree(plan)
    assert len(re.findall(r"(?<!Broadcast)Exchange \(", tree)) == 2
    assert len(re.findall(r"hashpartitioning\(", plan)) == 2
    assert "SortMergeJoin" not in tree and "ShuffledHashJoin" not in tree
    assert len(re.findall(r"\bWindow \(", tree)) == 1  # balance and next day in one pass
    assert "BroadcastHashJoin" in tree


def test_partial_aggregation_before_ledger_shuffle(spark):
    plan = _formatted(Q["interval_stock"](spark, SF001))
    assert "partial_sum(Quantity" in plan


def test_period_filters_reach_the_scan(spark):
    plan = _formatted(Q["store_benefits"](spark, SF001))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(l_shipdate,2001-01-01", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1999-01-01", plan)


def test_scans_are_column_pruned(spark):
    plan = _formatted(Q["interval_stock"](spark, SF001))
    for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan):
        assert "l_comment" not in schema and "l_extendedprice" not in schema
        assert "p_name" not in schema and "p_brand" not in schema


def test_no_python_in_any_query_plan(spark):
    for name, fn in Q.items():
        if name == "output_footprint":
            continue
        plan = _formatted(fn(spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" not in plan, name


def test_no_cartesian_products(spark):
    for name, fn in Q.items():
        if name == "output_footprint":
            continue
        plan = _formatted(fn(spark, SF001))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_daily_check_merges_without_extra_shuffle(spark):
    plan = _formatted(Q["check_daily_expansion"](spark, SF001))
    assert "SortMergeJoin" not in plan


def test_measures_share_one_cube_scan(spark):
    """Benefit and unpriced cost read one inbound cube: its exchange is reused."""
    df = Q["family_benefits_v2"](spark, SF001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_store_universe_reads_only_store_columns(spark):
    plan = _formatted(Q["store_universe"](spark, SF001))
    for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan):
        assert "l_quantity" not in schema and "l_shipdate" not in schema and "p_type" not in schema
