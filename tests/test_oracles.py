"""Every registered query against its oracle on the smallest driver data."""

from __future__ import annotations

import pytest
from compare import connect, differences

from workload.oracles import ORACLES
from workload.queries import QUERIES, run

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ours = run(name, spark, SF_DIR).toPandas()
    assert differences(ours, duck.execute(ORACLES[name]).df()) is None
    assert len(ours) > 0


@pytest.mark.parametrize(
    "name", ["ttv", "hotel_pay_measures", "tp_eur_measures", "fx_convert", "destination_code"]
)
def test_query_without_broadcast(spark, duck, name):
    """The shuffle plans used when no side is small give the same rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ours = run(name, spark, SF_DIR).toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert differences(ours, duck.execute(ORACLES[name]).df()) is None
