from __future__ import annotations

import pytest
from fixtures import booking, table
from pyspark.errors import AnalysisException

from staymart.sources import sinks
from staymart.sources.catalog import SCHEMAS, Source, jdbc_options, numbered, read_table, split_predicates


def test_file_source_reads_the_declared_schema(spark, tmp_path):
    table(spark, "booking", [booking(1), booking(0)]).write.parquet(
        str(tmp_path / "dwc_bok_t_booking")
    )
    source = Source("parquet", str(tmp_path / "{table}"))
    frame = read_table(spark, source, "booking", {"seq_reserva": "number"})
    assert frame.columns == ["number"]
    assert numbered(read_table(spark, source, "booking")).count() == 1


def test_jdbc_source_splits_large_tables():
    source = Source(
        "jdbc",
        "warehouse.{table}",
        {"url": "jdbc:postgresql://example/db"},
        {"sale": ("rres_seq_reserva", "0", "1000000", 64)},
    )
    options = jdbc_options(source, "sale")
    assert options["dbtable"] == "warehouse.dwc_bok_t_sale"
    assert options["partitionColumn"] == "rres_seq_reserva" and options["numPartitions"] == "64"
    assert "partitionColumn" not in jdbc_options(source, "tax")
    assert "imp_unitario decimal(18,6)" in options["customSchema"]
    with pytest.raises(ValueError, match="split"):
        jdbc_options(source, "cost")


def test_splits_follow_the_keys(spark):
    """Numbers in two far clusters, one number that a third of the rows have, and nulls."""
    keys = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5000000 WHEN id % 100 = 1 THEN NULL "
        "WHEN id < 4000 THEN id ELSE 1000000000 + id * id END AS n"
    )
    parts = split_predicates(keys, "n", 12)
    counts = keys.selectExpr(*[f"count_if({p}) AS c{i}" for i, p in enumerate(parts)]).first()
    assert sum(counts) == 9000  # nulls count in the first
    assert keys.where(" OR ".join(f"({p})" for p in parts)).count() == 9000
    assert sorted(counts)[-1] == 3000 and sorted(counts)[-2] <= 2 * 9000 / 12
    assert split_predicates(keys.limit(0), "n", 12) == ["1 = 1"] and split_predicates(keys, "n", 1) == ["1 = 1"]
    source = Source("jdbc", "{table}", {"url": "jdbc:postgresql://example/db"}, predicates={"sale": parts})
    assert "partitionColumn" not in jdbc_options(source, "sale")


def test_shared_folders_differ(spark):
    assert sinks.shared_folder(spark) != sinks.shared_folder(spark)


def test_every_schema_parses(spark):
    for name in SCHEMAS:
        assert table(spark, name, []).columns


def test_dated_sink(spark, tmp_path):
    frame = table(spark, "currency", [dict(cod_divisa="EUR", decimales=2)])
    path = sinks.write_extract(frame, str(tmp_path), "2017-03-26")
    assert path.endswith("daily_extract_2017-03-26")
    with pytest.raises(AnalysisException):
        sinks.write_extract(frame, str(tmp_path), "2017-03-26")
    sinks.write_extract(frame, str(tmp_path), "2017-03-26", mode="overwrite")
    assert sinks.read_extract(spark, str(tmp_path), "2017-03-26").count() == 1
