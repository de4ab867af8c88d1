"""Plan shape: how often each query reads its sources, and what it must not contain.

Reading a source table once per derived table is the floor for these queries;
a second read of the same lineage means a check or a serving table rescans the
orders, which at scale is a second pass over the largest table.
"""

import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from laminar.plans import registry
from laminar.plans.context import Warehouse
from laminar.session import storage_root

# query -> how many times it may read lineitem (each read is the whole order lineage)
ORDER_LINEAGE_READS = {
    "dwd_order_info": 1,
    "dws_product_daily_stats": 1,
    "ads_user_behavior": 1,
    "ads_sales_trend": 1,
    "geo_rollup": 1,
    "dq_accuracy": 1,
    "dq_order_retention": 1,
    # these read the orders that ``Warehouse.staged`` has written from one read of the lineage
    "dq_completeness": 0,
    "dq_findings": 0,
    "dq_report": 0,
    "layer_row_counts": 0,
}

# query -> how many times it may read the events table
EVENT_READS = {"login_count": 1, "fact_user_behavior": 1, "event_log_daily": 0}

# queries whose work is in the jobs they run; their plan only reads the result
WRITTEN_BY_JOBS = ("etl_roundtrip", "stream_dedup_ingest", "stream_user_daily", "stream_user_daily_bounded",
                   "stream_ods_landing", "ads_user_behavior_incremental",
                   "ads_sales_trend_incremental")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def _reads(plan):
    return Counter(p.rsplit("/", 1)[-1] for p in re.findall(r"file:[^\],\s]*\.parquet", plan))


@pytest.mark.parametrize("name,limit", sorted(ORDER_LINEAGE_READS.items()))
def test_order_lineage_read_count(spark, name, limit):
    assert _reads(_plan(spark, name))["lineitem.parquet"] == limit


def test_staging_reads_the_order_lineage_once(spark):
    plan = Warehouse(spark, SF_SMALL).ods_order_info._jdf.queryExecution().executedPlan().toString()
    assert _reads(plan)["lineitem.parquet"] == 1


def test_row_counts_stage_only_the_columns_they_count(spark):
    """The staged orders hold six columns, and the sources are read for these alone."""
    plan = _plan(spark, "layer_row_counts")
    staged = set(re.findall(r"staged-orders-[0-9a-f]+", plan))
    assert len(staged) == 1
    written = spark.read.parquet(f"{storage_root(spark)}/laminar/{staged.pop()}")
    assert sorted(written.columns) == ["dt", "order_id", "product_id", "product_name", "total_amount", "user_id"]


@pytest.mark.parametrize("name,limit", sorted(EVENT_READS.items()))
def test_event_read_count(spark, name, limit):
    assert _reads(_plan(spark, name))["events.parquet"] == limit


@pytest.mark.parametrize("name", [n for n in registry.queries()
                                  if n not in WRITTEN_BY_JOBS])
def test_no_nested_loop_cartesian_or_python(spark, name):
    plan = _plan(spark, name)
    assert not [op for op in FORBIDDEN if op in plan]


def test_rollup_expands_nations_not_orders(spark):
    """The ROLLUP's Expand sits above the per-nation aggregate, not above a join."""
    df = entry.queries()["geo_rollup"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    below_expand = plan[plan.index("Expand"):]
    first_agg, first_join = below_expand.find("Aggregate"), below_expand.find("Join")
    assert 0 <= first_agg < first_join
