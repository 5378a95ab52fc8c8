"""Stored measure tables side by side."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from staymart.plans.measure_tables import MEASURE_TABLES, side_by_side, stored_name
from workload.queries import run

SF_DIR = "/root/testdata/sf0.001"


def stored(spark, rows: dict[str, list]):
    """Tables with the given (office, number, amount); all other columns are null."""
    frames = {}
    for name, items in MEASURE_TABLES.items():
        columns = [f"CAST(amount AS DECIMAL(38,6)) AS {items[0].column}"]
        columns += [f"CAST(NULL AS DECIMAL(38,6)) AS {item.column}" for item in items[1:]]
        frame = spark.createDataFrame(rows.get(name, []), "grec_seq_rec long, seq_reserva long, amount string")
        frames[name] = frame.selectExpr("grec_seq_rec", "seq_reserva", *columns)
    return frames


@pytest.mark.parametrize("name", ["measure_star_join", "sql_star_extract"])
def test_the_stored_tables_take_one_join(spark, name):
    """Not one per table, whose sorts would all be in memory at once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = run(name, spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") < len(MEASURE_TABLES)


def test_values_of_a_booking_meet(spark):
    first, last = list(MEASURE_TABLES)[0], list(MEASURE_TABLES)[-1]
    a, b = (stored_name(name, MEASURE_TABLES[name][0]) for name in (first, last))
    rows = {first: [(1, 1, "-5.5"), (1, 2, None), (None, 3, "7")], last: [(1, 1, "2.000001"), (2, 1, "0")]}
    found = side_by_side(stored(spark, rows)).select("grec_seq_rec", "seq_reserva", F.col(a).cast("string"), F.col(b).cast("string"))
    assert {tuple(r) for r in found.collect()} == {
        (1, 1, "-5.500000", "2.000001"), (1, 2, None, None), (2, 1, None, "0.000000"), (None, 3, "7.000000", None),
    }


def test_a_booking_stored_twice_fails(spark):
    name = list(MEASURE_TABLES)[3]
    with pytest.raises(Exception, match="stored twice: booking 1-1"):
        side_by_side(stored(spark, {name: [(1, 1, "1"), (1, 1, "2")]})).collect()


def test_stored_tables_of_the_same_columns_share_one_exchange(spark):
    """Eleven of the twenty tables sum the same columns of the lines."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        text = run("measure_star_join", spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    lines = [row for row in text.splitlines() if "hashpartitioning(l_orderkey" in row and "ReusedExchange" not in row]
    assert 0 < len(lines) < len(MEASURE_TABLES) // 2
