"""Shape of the plans: no join without a key, no Python in the hot path, no one-task sort."""

import pytest
from pyspark.sql import functions as F

from tallymill.plans.catalog import ORACLES, QUERIES
from tallymill.plans.registry import Tables
from tallymill.sources.sharded import daily_tables, read_sharded

# Windows without a partition that see one row per period or per block only.
_SMALL_WINDOWS = ("_start", "_block", "_day")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan(spark, small, name):
    df = QUERIES[name](spark, small)
    plan = plan_of(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroups"):
        assert node not in plan, node
    # The sums of small cross-product matrices and their solution are the only Python here.
    for node in ("ArrowEvalPython", "MapInPandas"):
        assert (node in plan) == (name == "linear_by_group"), node
    # No window without a partition sees a whole table.
    pending = [df._jdf.queryExecution().optimizedPlan()]
    while pending:
        node = pending.pop()
        if node.nodeName() == "Window" and node.partitionSpec().isEmpty():
            order = node.orderSpec().toString()
            assert any(word in order for word in _SMALL_WINDOWS), order
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]


def test_scans_read_only_needed_columns(spark, small):
    plan = plan_of(QUERIES["first_response"](spark, small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan
    plan = plan_of(QUERIES["oldest_newest"](spark, small))
    assert "text" not in plan and "WindowGroupLimit" in plan


def test_period_filters_reach_the_scan(spark, small):
    for name in ("yoy_growth", "cohort_retention", "price_freight_by_month"):
        assert "GreaterThanOrEqual(" in plan_of(QUERIES[name](spark, small)), name
    # The daily tables outside the range are not opened at all.
    plan = plan_of(QUERIES["sum_in_suffix_range"](spark, small))
    assert "PartitionFilters: [isnotnull(suffix" in plan and "20240105" in plan


def test_several_columns_are_not_a_union_of_scans(spark, small):
    for name in ("numeric_histograms", "extreme_price_rows"):
        assert "Union" not in plan_of(QUERIES[name](spark, small)), name


def test_top_k_is_not_a_full_sort(spark, small):
    for name in ("top_active", "most_granted", "by_split_value", "size_profile"):
        plan = plan_of(QUERIES[name](spark, small))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan, name


def test_unknown_table_is_an_attribute_error(spark, small):
    with pytest.raises(AttributeError):
        Tables(spark, small).nothing


def test_daily_tables_are_laid_out_once(spark, small):
    """A second query opens the same folders, and only those of its sixteen days."""
    source = f"{small}/events.parquet"
    first = daily_tables(spark, source, F.col("ts"))
    assert daily_tables(spark, source, F.col("ts")) == first
    days = read_sharded(spark, first, "20240105", "20240120")
    plan = plan_of(days)
    assert "PartitionFilters: [isnotnull(suffix" in plan
    opened = {f.split("suffix=")[1].split("/")[0] for f in days.inputFiles()}
    everything = {f.split("suffix=")[1].split("/")[0] for f in spark.read.parquet(first).inputFiles()}
    assert opened <= everything and days.select("suffix").distinct().count() <= 16 < len(everything)
