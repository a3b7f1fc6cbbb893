"""Registered queries against their SQL, and the shape of their plans."""

import pytest

import __spark_entry__ as entry
from catalog.queries import QUERIES
from tests.oracle_check import compare, connect

# Fits of the full forest are compared by the driver, not in the unit tests.
SLOW = {"publish_explanations", "chained_impute_checks", "run_all_job", "wide_forest"}
LAZY = [
    "scan_features",
    "scan_pushdown",
    "control_upsert",
    "key_projection",
    "cast_by_name",
    "rename_calendar",
    "retention_expired",
    "parse_run_stamp",
    "lookup_broadcast",
    "label_counts",
    "column_profile",
    "level_counts",
    "split_hash",
    "map_categories",
    "difference_features",
    "round_features",
]


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, con, small, name):
    assert compare(spark, con, name, small) == ""


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_cross_join(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["scan_pushdown"](spark, small))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert "c_nationkey" not in text
    keys = plan(QUERIES["key_projection"](spark, small))
    assert "l_extendedprice" not in keys and "lineitem" not in keys
