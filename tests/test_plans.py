"""The physical plans keep the shapes the design counts on."""

import re

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry


def plan(spark, name):
    return entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "daily_rollup", "lifecycle_by_date", "daily_by_category", "dense_grid", "rolling_by_category", "rolling_timeseries",
    "dedup_first", "slice_grid", "slice_cap", "permits_by_date", "html_detail_join", "latest_non_null", "top_groups",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "MapInPandas" not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, "daily_rollup")
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_comment" not in scan and "l_extendedprice" not in scan and "l_tax" not in scan


def test_recent_window_reaches_the_scan(spark):
    query = entry.queries()["recent_window"](spark, SF_DIR)._jdf.queryExecution()
    text = query.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    text = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(l_shipdate" in text and "GreaterThan(l_extendedprice" in text


def test_lifecycle_rollup_scans_facts_once(spark):
    text = plan(spark, "lifecycle_by_date")
    assert sum("lineitem.parquet" in line for line in text.splitlines()) == 1


def test_facts_are_aggregated_before_the_calendar(spark):
    text = plan(spark, "daily_rollup")
    assert "partial_sum" in text[text.index("Join") :]


def test_capped_slices_are_cut_before_the_shuffle(spark):
    # Before and after the shuffle, for the parts of a slice and for the slice.
    assert plan(spark, "slice_cap").count("WindowGroupLimit") == 4


def largest_method(spark, name, capsys):
    """Bytes of the largest method that Spark generates for a query."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        entry.queries()[name](spark, SF_DIR).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))


# The JVM compiles no method above 8000 bytes.


def test_typed_permits_are_compiled(spark, capsys):
    assert largest_method(spark, "permits_typed", capsys) < 8000


def test_cleaned_permits_are_compiled(spark, capsys):
    assert largest_method(spark, "permits_cleaned", capsys) < 8000
