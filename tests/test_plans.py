"""Plan shape of every registered query: no pair-producing joins, pruned scans."""
import pytest

import __spark_entry__ as E
from ordwise.plans import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_pairwise_joins(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_every_query_scans_a_table(spark):
    for name in ("gen_records", "gen_sort_rank", "gen_sort_validate"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "orders.parquet" in plan and "Range (" not in plan, name


def test_scans_are_pruned(spark):
    plan = E.queries()["key_prefix"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    plan = E.queries()["order_violations"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan


def test_even_sort_has_no_sampling_exchange(spark):
    df = E.queries()["sort_total_order"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "rangepartitioning" not in plan
    # rows and counts come from one shuffle
    assert plan.count("ReusedExchange") == 1 and plan.count("- Exchange shufflepartitionidpassthrough") == 1
