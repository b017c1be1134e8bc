"""Plan lint: every catalogued query stays JVM-side and free of all-pairs joins.

Walks the executed physical plan (after AQE) of each query and rejects
Cartesian products, nested-loop joins and Python evaluation nodes. Scans of
the base tables must prune columns (no query reads every column of
``lineitem``).
"""

import re

import pytest

from conftest import SF_SMALL
from opslens.plans.catalogue import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF", "RoundRobinPartitioning")
LINEITEM_COLUMNS = 11


def executed_plan(df) -> str:
    df.collect()  # AQE finalises the plan during execution
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_lean(spark, name):
    plan = executed_plan(QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node} in plan"
    for line in plan.splitlines():
        scan = re.search(r"FileScan parquet\s*\S*?\[([^\]]*)\]", line)
        if scan and "lineitem.parquet" in line:
            cols = [c for c in scan.group(1).split(",") if c.strip()]
            assert len(cols) < LINEITEM_COLUMNS, f"{name}: unpruned lineitem scan"


def plan_of(spark, name) -> str:
    return executed_plan(QUERIES[name](spark, SF_SMALL))


def test_sample_is_a_distributed_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "purchase_sample")


def test_decode_drops_failures_without_a_second_decode(spark):
    plan = plan_of(spark, "envelope_decode")
    assert "Generate explode" in plan
    assert not any("Filter" in line and "from_json" in line for line in plan.splitlines())


@pytest.mark.parametrize("name", ["machine_rollup", "machine_summary", "customer_summary"])
def test_aggregates_hash_based_and_pre_aggregated(spark, name):
    """Every shuffle carries aggregated rows; no grouped aggregate falls back to sorting its input.

    A keyless SortAggregate (a global aggregate with a struct-ordered ``min_by``
    over a few rows per key) iterates without sorting and is allowed.
    """
    plan = plan_of(spark, name).split("== Initial Plan ==")[0]
    assert not re.search(r"SortAggregate\(key=\[[^\]]", plan), f"{name}: sort-based grouped aggregate"
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = next(x for x in lines[i + 1:] if x.strip().lstrip("+-: ").strip())
            assert "Aggregate" in below, f"{name}: raw rows shuffled"


def test_grouping_sets_expand_cells_not_rows(spark):
    """The rows are aggregated before they are multiplied by the grouping sets."""
    lines = plan_of(spark, "customer_summary").split("== Initial Plan ==")[0].splitlines()
    at = [i for i, line in enumerate(lines) if re.search(r"\bExpand\b", line)]
    assert at
    for i in at:
        below = next(x for x in lines[i + 1:] if x.strip(" +-:*()0123456789"))
        assert "Aggregate" in below


def test_machine_rollup_has_one_shuffle(spark):
    assert plan_of(spark, "machine_rollup").split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def test_bucketed_rollup_has_no_shuffle(spark):
    assert "Exchange" not in plan_of(spark, "bucketed_rollup").split("== Initial Plan ==")[0]
