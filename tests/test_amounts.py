from __future__ import annotations

from decimal import Decimal

from fixtures import day
from pyspark.sql import functions as F

from staymart.functions import amounts, attributes


def row(spark, schema: str, *values):
    return spark.createDataFrame([values], schema)


def value(frame, column):
    return frame.select(column.alias("v")).first()["v"]


def night(spark, unit_type, ps, start="2017-05-01", end="2017-05-04", days=None):
    frame = row(
        spark,
        "s timestamp, e timestamp, u int, p int, t string, f string, a double, d int",
        start and day(start),
        end and day(end),
        3,
        2,
        unit_type,
        ps,
        10.0,
        days,
    )
    c = [F.col(n) for n in "s e u p t f a".split()]
    return value(frame, amounts.night_amount(*c, days=F.col("d")))


def test_night_amount(spark):
    assert night(spark, "N", "P") == 10 * 3 * 2
    assert night(spark, "S", "S") == 10 * 4 * 3
    assert night(spark, "X", "S") == 10 * 1 * 3
    assert night(spark, "N", "S", end="2017-05-01") == 0
    assert night(spark, "S", "S", end="2017-05-01") == 10 * 1 * 3
    assert night(spark, "N", "S", end=None) == 0
    assert night(spark, "N", "S", days=5) == 10 * 5 * 3
    assert night(spark, "N", "S", days=0) == 10 * 3 * 3


def test_contained_tax_and_share(spark):
    frame = row(spark, "a double, p double", 110.0, 10.0)
    assert abs(value(frame, amounts.contained_tax(F.col("a"), F.col("p"))) - 10) < 1e-9
    assert abs(value(frame, F.col("a") * amounts.tax_share(F.col("p"))) - 10) < 1e-9


def test_rounding_is_half_up_and_leaves_unknown_currencies_alone(spark):
    for amount, decimals, expected in [
        ("1.255", 2, "1.26"),
        ("-1.255", 2, "-1.26"),
        ("2.5", 0, "3"),
        ("1.2345", 3, "1.235"),
        ("1.23456", None, "1.23456"),
        ("1.23456", 9, "1.23456"),
    ]:
        frame = row(spark, "a decimal(18,6), d int", Decimal(amount), decimals)
        assert value(frame, amounts.round_to_scale(F.col("a"), F.col("d"))) == Decimal(expected)


def test_rounded_unit_matches_round_to_scale(spark):
    for micros, scale, expected in [(1255000, 2, 1.26), (2500000, 0, 3.0), (1234499, 3, 1.234)]:
        frame = row(spark, "m double", float(micros))
        assert value(frame, F.expr(amounts.rounded_unit_sql("m", scale))) == expected


def test_status_date_and_texts(spark):
    frame = row(
        spark,
        "c timestamp, m timestamp, x timestamp",
        day("2017-03-01T23:00:00"),
        None,
        day("2017-03-05T01:02:03"),
    )
    c, m, x = (F.col(n) for n in "cmx")
    assert str(value(frame, attributes.status_date(c, m, x))) == "2017-03-05"
    assert value(frame, attributes.second_text(x)) == "2017-03-05 01:02:03"
    assert value(frame, attributes.day_text(m)) == ""


def test_resale_status(spark):
    def status(code, cancelled, conditional="RL"):
        frame = row(spark, "s string, x timestamp", code, cancelled)
        return value(frame, attributes.resale_status(F.col("s"), F.col("x"), conditional))

    gone = day("2017-03-05")
    assert status("RR", None) == "Reventa"
    assert status("CN", gone) == "Liberada"
    assert status("RL", None) == "Reventa"
    assert status("RL", gone) == "Cancelada"
    assert status("RV", gone) is None
    assert status("RV", gone, "RV") == "Cancelada"
    assert status("RL", gone, "RV") == "Liberada"
    assert status("ZZ", None) is None
    assert status(None, None) is None
