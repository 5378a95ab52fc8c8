"""Shape of the physical plans."""

from __future__ import annotations

import re

import pytest

from workload.queries import QUERIES, run

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    return run(name, spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "sink_roundtrip"])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "MapInPandas"):
        assert operator not in text


def test_one_scan_of_the_amounts_for_all_hotel_payment_measures(spark):
    """What the lines' currencies ask for is read by a second scan, which takes no amounts."""
    text = plan(spark, "hotel_pay_measures")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem\.parquet", text)
    assert len(scans) == 2
    assert sorted("l_extendedprice" in columns for columns in scans) == [False, True]


def test_lines_are_aggregated_before_any_join_to_the_booking(spark):
    text = plan(spark, "ttv")
    scan = text.index("lineitem.parquet")
    assert "Join" not in text[text.rindex("partial_sum", 0, scan) : scan]


def test_unused_tax_lookup_is_pruned(spark):
    assert "part.parquet" not in plan(spark, "ttv")
    assert "part.parquet" in plan(spark, "tax_ttv")


def test_scan_reads_only_what_it_needs(spark):
    text = plan(spark, "scan_projected")
    schema = text[text.index("ReadSchema") :]
    assert "l_extendedprice" in schema and "l_shipdate" not in schema


def test_first_row_limits_groups_before_the_shuffle(spark):
    text = plan(spark, "dedupe_by_key")
    assert text.count("WindowGroupLimit") >= 2


def test_no_explode_of_rates_is_interpreted(spark):
    """A function over an array below an explode keeps Spark from compiling either."""
    explodes = [row for row in plan(spark, "cost_measures").splitlines() if "Generate " in row]
    assert explodes and not [row for row in explodes if "lambdafunction" in row]


def test_rows_that_lack_no_rate_are_not_told_apart_by_measure(spark):
    rows = plan(spark, "unrated_amounts").splitlines()
    at = next(i for i, row in enumerate(rows) if "Generate explode" in row)
    assert any("Filter " in row and "source" in row for row in rows[at + 1 : at + 4])
