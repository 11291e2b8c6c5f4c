"""Plan shapes that must hold at any scale, with every join too big to broadcast."""

import re
from pathlib import Path

import pytest

from weirline.workload import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data here")

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
}


@pytest.fixture(scope="module")
def plans(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    try:
        yield {
            name: query(spark, DATA)._jdf.queryExecution().executedPlan().toString()
            for name, query in registry.queries().items()
        }
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_python_and_no_cross_join(plans):
    for name, plan in plans.items():
        for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_only_the_two_median_slots_are_broadcast(plans):
    for name, plan in plans.items():
        joins = re.findall(r"BroadcastHashJoin \[(\w+)", plan)
        assert set(joins) <= {"_slot"}, (name, joins)


def test_order_lines_are_read_once(plans):
    for name, plan in plans.items():
        if name.startswith("median_"):
            continue  # two scans; see below
        assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) <= 1, name


def test_median_reads_twice_and_shuffles_counts(plans):
    """A scan for the bracket and one for the counts, whose shuffle all other steps reuse;
    what travels are sketches and counts, combined before."""
    for name in ("median_order_value", "median_double"):
        plan = plans[name]
        assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) == 2, name
        assert plan.count("ReusedExchange") == 2, name
        lines = plan.splitlines()
        for above, below in zip(lines, lines[1:]):
            if "- Exchange " in above and "hashpartitioning(_slot" not in above:
                assert "Aggregate(" in below, (name, below)


def test_order_line_scans_are_pruned(plans):
    for name in ("fact_leakage", "fact_revenue_monthly", "dim_region"):
        (schema,) = re.findall(r"lineitem\.parquet.*ReadSchema: (\S+)", plans[name])
        assert "l_shipdate" not in schema and "l_returnflag" not in schema


def test_outlier_cut_reaches_the_scan(plans):
    plan = plans["outlier_filter"]
    assert "LessThanOrEqual(l_extendedprice,50000.0)" in plan and "Exchange" not in plan


def test_every_grouping_combines_before_its_shuffle(plans):
    """Below each hash shuffle that feeds an aggregate stands a partial aggregate."""
    for name, plan in plans.items():
        lines = [re.sub(r"^[\s:+\-|*]*(\(\d+\)\s*)?", "", x) for x in plan.splitlines()]
        for above, shuffle, below in zip(lines, lines[1:], lines[2:]):
            if above.startswith("HashAggregate") and shuffle.startswith("Exchange"):
                assert re.match(r"(Hash|Sort)Aggregate", below), (name, below)
        for above, sort, shuffle, below in zip(lines, lines[1:], lines[2:], lines[3:]):
            if above.startswith("SortAggregate") and shuffle.startswith("Exchange"):
                assert below.startswith("SortAggregate"), (name, below)
