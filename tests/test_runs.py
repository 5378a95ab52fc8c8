"""Repeatable runs: clustered layout, reconciliation, merged extracts, skew-safe tax lookup."""

from __future__ import annotations

import re
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from staymart.operators.lookups import LINE_TAX_KEYS, TAX_KEYS, exclude_whole_keys, tax_lookup
from staymart.operators.full_exchange import rate_sources
from staymart.plans import measures
from staymart.plans.reconcile import reconcile, reconcile_summary
from staymart.plans.rollup import rollup_lines
from staymart.sources.catalog import changed_bookings
from staymart.sources.layout import CLUSTER_KEYS, Clustered, bucket_count, write_clustered
from staymart.sources.sinks import merge_extract
from workload import queries
from workload.queries import _components, _converter, _cost, _recharged_cost, _sale
from workload.tables import Tables

SF_DIR = "/root/testdata/sf0.001"


def exchanges(frame) -> list[str]:
    text = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^\n]*)", text)


def test_no_line_moves_on_the_clustered_layout(spark, tmp_path):
    tables, prefix = Tables(spark, SF_DIR), f"t{uuid.uuid4().hex}"
    write_clustered(tables, ["booking", "cost"], f"file://{tmp_path}", prefix, 8)
    clustered = Clustered(spark, prefix, ["booking", "cost"], tables)
    assert set(clustered) == set(tables) and len(clustered) == len(tables)

    def plan(t):
        return exchanges(measures.booking_measures(t, _cost(t), measures.HOTEL_PAYMENT, _converter(t)))

    by_booking = re.compile("line_seq_rec|grec_seq_rec|__within")
    assert [e for e in plan(tables) if by_booking.search(e)]
    assert not [e for e in plan(clustered) if by_booking.search(e)]
    # A file per bucket.
    assert clustered["cost"].select(F.input_file_name().alias("f")).distinct().count() <= 8


def test_rates_are_prepared_once_for_all_windows(spark, monkeypatch):
    prepared = []

    def counted(*args, **options):
        prepared.append(args)
        return rate_sources(*args, **options)

    monkeypatch.setattr(queries, "rate_sources", counted)
    assert queries.incremental_extract(Tables(spark, SF_DIR)).count() == 1500
    assert len(prepared) == 1


def test_lines_cross_the_network_once(spark):
    """Dealt out by booking before they are summed; neither sums nor joins move them again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = Tables(spark, SF_DIR)
        for rows, wanted in ((_sale(tables), measures.TAX_TTV), (_components(tables), measures.COMPONENT)):
            moved = exchanges(measures.booking_measures(tables, rows, wanted, _converter(tables)))
            # The exclusion takes its few lines by their whole key.
            by_booking = [e for e in moved if "line_seq_rec" in e and "component_ord" not in e]
            assert len(by_booking) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_a_whole_key_pass_by_the_exclusion(spark):
    """Most cost lines are not recharged; only those with an extra are moved to the excluded keys."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = Tables(spark, SF_DIR)
        rolled = _recharged_cost(tables)
        # A scan of its own for either kind, its filter below the sums.
        text = rolled._jdf.queryExecution().executedPlan().toString()
        assert text.count("LeftAnti") == 1 and "Union" in text
        every = rollup_lines(tables["cost"], tables["tax"], "sdiv_cod_divisa")
        assert 0 < rolled.agg(F.sum("gross")).first()[0] < every.agg(F.sum("gross")).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.createDataFrame([(1, 1, "a"), (1, None, "b"), (1, 2, "c"), (None, 1, "d")], "k int, part int, n string")
    gone = spark.createDataFrame([(1, 1), (2, 2)], "x int, y int")
    assert sorted(r.n for r in exclude_whole_keys(rows, gone, {"k": "x", "part": "y"}, "part").collect()) == ["b", "c", "d"]


def test_buckets_follow_the_rows(spark):
    """A bucket is one task's: it must not grow with the tables."""
    tables = {"booking": spark.range(90), "cost": spark.range(1001)}
    assert bucket_count(tables, ["booking", "cost"], 4, rows=100) == 11
    assert bucket_count(tables, ["booking"], 4, rows=100) == 4


def test_cluster_keys_follow_the_booking_key():
    assert CLUSTER_KEYS["booking"] == ("grec_seq_rec", "seq_reserva")
    assert CLUSTER_KEYS["sale"] == ("grec_seq_rec", "rres_seq_reserva")
    assert CLUSTER_KEYS["resale"] == ("seq_rec", "seq_reserva")


def test_tax_lookup_of_keyless_and_hot_lines(spark):
    """40 % of the lines lack a whole key, half of the others have one key."""
    keys = [f"CASE WHEN id % 10 < 4 THEN NULL WHEN id % 2 = 0 THEN 'hot' ELSE concat('k', id % 37) END AS {k}" for k in LINE_TAX_KEYS[:1]]
    keys += [f"CASE WHEN id % 10 >= 4 AND id % 2 = 0 THEN 'hot' ELSE concat('k', id % 37) END AS {k}" for k in LINE_TAX_KEYS[1:]]
    lines = spark.range(40_000).selectExpr("id", *keys)
    rates = spark.range(37).selectExpr(*[f"concat('k', id) AS {k}" for k in TAX_KEYS], "CAST(id AS DECIMAL(10,4)) AS pct_impuesto")
    rates = rates.union(spark.range(1).selectExpr(*[f"'hot' AS {k}" for k in TAX_KEYS], "CAST(99 AS DECIMAL(10,4)) AS pct_impuesto"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for salts in (8, 64):
            found = tax_lookup(lines, rates, spread_by=("id",), salts=salts)
            assert found.columns == [*lines.columns, "pct_impuesto"]
            rows = found.groupBy("pct_impuesto").count().collect()
            counts = {None if r.pct_impuesto is None else int(r.pct_impuesto): r["count"] for r in rows}
            assert counts[None] == 16_000 and counts[99] == 12_000 and sum(counts.values()) == 40_000
            assert tax_lookup(lines, rates, how="inner", spread_by=("id",), salts=salts).count() == 24_000
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("count"), F.max("pct_impuesto")).collect())
        assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_every_verdict(spark):
    stored = spark.createDataFrame([(1, 1, 10.0, None), (1, 2, 10.0, 5.0), (1, 3, 10.0, None), (None, 9, 0.0, 1.0), (4, 4, 1.0, 1.0)], "a long, b long, x double, y double")
    computed = spark.createDataFrame([(1, 1, 10.0, None), (1, 2, 10.004, 7.0), (1, 3, 10.2, 0.0), (None, 9, 0.0, 1.0), (5, 5, 1.0, 1.0)], "a long, b long, u double, v double")
    rows = reconcile(stored, computed, ["a", "b"], {"m": ("x", "u"), "n": ("y", "v")})
    found = {(r.a, r.b, r.measure): r.verdict for r in rows.collect()}
    assert found == {
        (1, 1, "m"): "equal", (1, 1, "n"): "equal", (1, 2, "m"): "close", (1, 2, "n"): "different",
        (1, 3, "m"): "different", (1, 3, "n"): "different", (None, 9, "m"): "equal", (None, 9, "n"): "equal",
        (4, 4, "m"): "missing", (4, 4, "n"): "missing", (5, 5, "m"): "extra", (5, 5, "n"): "extra",
    }
    loose = reconcile(stored, computed, ["a", "b"], {"m": ("x", "u")}, relative=0.05)
    assert {r.b: r.verdict for r in loose.collect()}[3] == "close"
    totals = {(r.measure, r.verdict): r.n_bookings for r in reconcile_summary(rows).collect()}
    assert totals["m", "equal"] == 2 and totals["n", "different"] == 2
    assert reconcile(stored.limit(0), computed.limit(0), ["a", "b"], {"m": ("x", "u")}).count() == 0


BOOKINGS = "grec_seq_rec long, seq_reserva long, fec_creacion timestamp, fec_modifica timestamp, fec_cancelacion timestamp, amount double"


def moment(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def test_merged_extract_follows_late_changes(spark, tmp_path):
    path = f"file://{tmp_path}/extract"
    keys = ["grec_seq_rec", "seq_reserva"]

    def state(rows):
        return spark.createDataFrame([(1, n, moment(a), moment(b), moment(c), v) for n, a, b, c, v in rows], BOOKINGS)

    def run(rows, start, end):
        changed = changed_bookings(state(rows), start, end)
        merge_extract(changed.select(*keys, "amount", F.date_format("fec_creacion", "yyyy-MM").alias("created")), path, keys, "created")
        return {(r.seq_reserva, r.created): r.amount for r in spark.read.parquet(path).withColumn("created", F.col("created").cast("string")).collect()}

    first = [(1, "2017-01-05", None, None, 1.0), (2, "2017-01-20", None, None, 2.0), (3, "2017-02-03", None, None, 3.0)]
    assert run(first, "2017-01-01", "2017-02-28") == {(1, "2017-01"): 1.0, (2, "2017-01"): 2.0, (3, "2017-02"): 3.0}
    # One of January is modified in March, one is cancelled, one is new; 2 stays as it was.
    second = [
        (1, "2017-01-05", "2017-03-09", None, 10.0), (2, "2017-01-20", None, None, 99.0),
        (3, "2017-02-03", None, "2017-03-02", 0.0), (4, "2017-03-03", None, None, 4.0),
    ]
    want = {(1, "2017-01"): 10.0, (2, "2017-01"): 2.0, (3, "2017-02"): 0.0, (4, "2017-03"): 4.0}
    assert run(second, "2017-03-01", "2017-03-31") == want
    assert run(second, "2017-03-01", "2017-03-31") == want
    assert run(second, "2018-01-01", "2018-12-31") == want
