from __future__ import annotations

import random
from datetime import timedelta

from fixtures import day, table, tables
from pyspark.sql import functions as F

from staymart.operators import exchange
from staymart.operators.asof import BACKWARD, FORWARD, asof_lookup, intervals


def brute(history, key, at, direction):
    """The row in force, by looking at every row."""
    same = [h for h in history if h[0] == key]
    if direction == BACKWARD:
        return max((h for h in same if h[1] <= at), default=(None,) * 3)[2]
    return min((h for h in same if h[1] >= at), default=(None,) * 3)[2]


def test_asof_lookup_against_brute_force(spark):
    rng = random.Random(7)
    start = day("2015-01-01")
    # One key holds most of the history and most of the rows.
    keys = ["hot"] * 8 + ["a", "b"]
    seen = {}
    for _ in range(300):
        seen[rng.choice(keys), start + timedelta(hours=rng.randrange(30000))] = rng.random()
    history = [(k, at, v) for (k, at), v in seen.items()]
    rows = [
        (i, rng.choice([*keys, "none"]), start + timedelta(hours=rng.randrange(-9000, 50000)))
        for i in range(600)
    ]
    rows += [(1000 + i, k, at) for i, (k, at, _) in enumerate(history)]
    left = spark.createDataFrame(rows, "i int, k string, at timestamp")
    right = spark.createDataFrame(history, "k string, eff timestamp, v double")
    for direction in (BACKWARD, FORWARD):
        prepared = intervals(right, ["k"], "eff", direction)
        found = asof_lookup(left, prepared, {"k": "k"}, "at", {"v": "out"}).collect()
        assert len(found) == len(rows)
        assert {r["i"]: r["out"] for r in found} == {
            i: brute(history, k, at, direction) for i, k, at in rows
        }


def test_history_with_any_date_stays_small(spark):
    history = [("EUR", f"2017-{m:02d}-{d:02d} 00:00:00", float(m)) for m in range(1, 13) for d in (1, 15)]
    history += [("EUR", "0001-01-01 00:00:00", 0.5), ("EUR", "9999-12-31 00:00:00", 99.0), ("USD", None, 1.0)]
    frame = spark.createDataFrame(history, "k string, eff string, v double").withColumn("eff", F.col("eff").cast("timestamp"))
    prepared = intervals(frame, ["k"], "eff")
    assert prepared.frame.count() <= 2 * len(history) + 2
    asked = [("1900-01-01", 0.5), ("2017-03-16", 3.0), ("5000-01-01", 12.0), ("9999-12-31", 99.0)]
    left = spark.createDataFrame([("EUR", at) for at, _ in asked], "k string, at string")
    left = left.withColumn("at", F.col("at").cast("timestamp")).withColumn("day", F.col("at").cast("string"))
    found = asof_lookup(left, prepared, {"k": "k"}, "at", {"v": "out"}).collect()
    assert {r["day"][:10]: r["out"] for r in found} == dict(asked)


def rate(spark, source, target, at, partner=5):
    t = tables(spark)
    rows = spark.createDataFrame(
        [(partner, source, target, day(at))], "p bigint, f string, t string, at timestamp"
    )
    book = exchange.rate_book(t["partner_rate"], by_partner=True)
    return exchange.triangulated_rate(rows, book, "p", "f", "t", "at", "r").first()["r"]


def test_partner_rates(spark):
    assert rate(spark, "USD", "USD", "2010-01-01") == 1
    assert rate(spark, "USD", "EUR", "2017-02-15") == 0.5
    assert rate(spark, "USD", "EUR", "2017-03-15") == 0.25  # later inverse
    assert rate(spark, "USD", "EUR", "2017-04-01") == 0.75  # stored pair on the same day
    assert rate(spark, "EUR", "USD", "2017-04-01") == 5
    assert rate(spark, "USD", "EUR", "2016-12-31") is None
    assert rate(spark, "USD", "EUR", "2030-01-01") == 0.75
    assert rate(spark, "GBP", "USD", "2017-03-15") == 2 * 4  # through the euro
    assert rate(spark, "GBP", "XXX", "2017-03-15") is None
    assert rate(spark, "USD", "EUR", "2017-02-15", partner=6) is None


def test_company_rate_type_takes_the_next_date(spark):
    types = table(
        spark,
        "company_rate_type",
        [
            dict(
                semp_cod_emp="E1",
                fec_aplicacion=day(at),
                tipo_cambio_rex=f"r{i}",
                tipo_cambio_caj=f"c{i}",
                tipo_cambio_liq=f"l{i}",
                tipo_cambio_ctb=f"a{i}",
            )
            for i, at in enumerate(["2017-01-01", "2017-06-01"])
        ],
    )
    rows = spark.createDataFrame(
        [
            (1, "E1", "R", day("2016-05-05")),
            (2, "E1", "C", day("2017-01-01")),
            (3, "E1", "L", day("2017-01-02")),
            (4, "E1", "A", day("2017-07-01")),
            (5, "E9", "R", day("2017-01-01")),
            (6, "E1", "Q", day("2017-01-01")),
        ],
        "i int, e string, purpose string, at timestamp",
    )
    found = exchange.company_rate_type(rows, types, "e", "purpose", "at", "kind").collect()
    assert {r["i"]: r["kind"] for r in found} == {
        1: "r0", 2: "c0", 3: "l1", 4: "ERROR", 5: "ERROR", 6: "ERROR",
    }


def test_currency_exchange_applies_rate_spread_and_rounding(spark):
    t = tables(
        spark,
        spread=[
            dict(
                tipo_cambio="T",
                cod_div_origen="USD",
                cod_div_destino="EUR",
                fec_aplicacion=day("2017-01-01"),
                pct_venta=10,
                pct_compra=20,
                pct_fixing=0,
            )
        ],
    )
    rows = spark.createDataFrame(
        [
            (1, 100.0, "USD", "EUR", "V"),
            (2, 100.0, "USD", "EUR", "C"),
            (3, 10.555, "USD", "USD", "V"),
            (4, 10.0, "USD", "GBP", "V"),
            (5, 10.0, "XXX", "EUR", "V"),
        ],
        "i int, a double, f string, t string, kind string",
    ).selectExpr("*", "TIMESTAMP'2017-02-01' AS at", "'T' AS rate_type")
    exchanged = exchange.currency_exchange(
        rows, t["partner_rate"], t["spread"], t["currency"], "a", "f", "t", "at", "rate_type",
        "kind", "out",
    )
    found = {r["i"]: r["out"] and float(r["out"]) for r in exchanged.collect()}
    # 10 USD -> 5 EUR -> 2.5 GBP, which has no decimals.
    assert found == {1: 55.0, 2: 60.0, 3: 10.56, 4: 3.0, 5: None}


def test_daily_rate_defaults_to_zero(spark):
    t = tables(spark)
    rows = spark.createDataFrame(
        [("USD", day("2017-03-10T23:59:59")), ("USD", day("2017-03-11")), ("X", day("2017-03-10"))],
        "ccy string, at timestamp",
    )
    found = exchange.daily_rate(rows, t["daily_rate"], "ccy", "at", "r").collect()
    assert sorted(r["r"] for r in found) == [0.0, 0.0, 0.25]


def test_rate_request_needs_company_type_dates_and_currencies(spark):
    frame = spark.createDataFrame(
        [
            ("E1", "R", "d", "USD", "EUR"),
            ("E1", "Z", "d", "USD", "EUR"),
            (None, "R", "d", "USD", "EUR"),
            ("E1", None, "d", "USD", "EUR"),
            ("E1", "R", None, "USD", "EUR"),
            ("E1", "R", "d", None, "EUR"),
        ],
        "c string, t string, at string, f string, z string",
    )
    from pyspark.sql import functions as F

    valid = exchange.valid_rate_request(*[F.col(n) for n in ("c", "t", "at", "f", "z")])
    assert [r["v"] for r in frame.select(valid.alias("v")).collect()] == [True] + [False] * 5
