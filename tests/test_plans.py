"""Properties of physical plans that matter on large tables."""

import re

import pytest

from nightgrid.catalog import QUERIES, bases

SF_DIR = "/root/testdata/sf0.001"
PYTHON = ("FlatMapGroupsIn", "FlatMapCoGroupsIn", "MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython")
# Blocks of detectors, and the look at the headers of files.
WITH_PANDAS = {"pairwise_correlation", "detector_correlation", "load_broken_lines", "load_flat_dir", "load_recursive_dir", "union_sources"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {key: plan(build(spark, SF_DIR)) for key, build in QUERIES.items()}


def test_no_cross_joins(plans):
    bad = [k for k, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert bad == []


def test_python_only_for_pairs_of_detectors_and_headers(plans):
    assert {k for k, p in plans.items() if any(x in p for x in PYTHON)} == WITH_PANDAS


def test_no_repeated_subqueries(plans):
    many = {k: p.count("FileScan") for k, p in plans.items() if p.count("FileScan") > 5}
    assert many == {}


@pytest.mark.parametrize(
    "key, exchanges",
    [("calls_per_night", 1), ("detector_activity_summary", 2), ("prepare_master", 1),
     ("dedup_keep_first", 1), ("condense", 1), ("unify_schema", 0), ("to_local_time", 0)],
)
def test_one_scan_and_few_shuffles(plans, key, exchanges):
    assert plans[key].count("FileScan") == 1
    assert len(re.findall(r"Exchange ", plans[key])) == exchanges


def test_columns_are_pruned(spark, plans):
    def columns(text):
        return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", text).group(1)))

    assert columns(plans["calls_per_night"]) == {"event_id", "ts", "user_id", "event_type"}
    assert columns(plans["require_rows"]) == {"event_id", "event_type"}


def test_filters_reach_the_scan(spark):
    from nightgrid.operators.clean import filter_noid

    scanned = bases.table(spark, SF_DIR, "events").withColumnRenamed("event_type", "auto_id")
    assert "PushedFilters: [Or(Not(EqualTo(event_type,NoID)),IsNull(event_type))]" in plan(filter_noid(scanned))


def test_ordering_over_all_rows_only_after_aggregation(plans):
    """A window in one task sits on aggregated rows, never on a scan."""
    for key, text in plans.items():
        for match in re.finditer(r"Window \[.*\n((?:.*\n)*?).*Exchange SinglePartition.*\n((?:.*\n)*)", text):
            assert "HashAggregate" in match.group(2) or "Aggregate" in match.group(2), key
