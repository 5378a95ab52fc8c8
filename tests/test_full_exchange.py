"""The exchange chain against plain Python, and its plans."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from staymart.operators.asof import FORWARD, asof_lookup, intervals
from staymart.operators.full_exchange import Asked, FullConverter, attach_rates, full_exchange, rate_sources, split_rejects

START = datetime(2015, 1, 1)
CURRENCIES = ["EUR", "USD", "GBP", "JPY", "CHF"]
SCHEMAS = {
    "partner_rate": "seq_ttoo long, cod_divisa_ori string, cod_divisa_des string, fec_desde timestamp_ntz, nro_tasa double",
    "type_rate": "tipo_cambio string, cod_div_origen string, cod_div_destino string, fec_aplicacion timestamp_ntz, nro_tasa double",
    "daily_rate": "date date, currency string, rate double",
    "company_rate_type": "semp_cod_emp string, fec_aplicacion timestamp_ntz, tipo_cambio_rex string, tipo_cambio_caj string, tipo_cambio_liq string, tipo_cambio_ctb string",
    "spread": "tipo_cambio string, cod_div_origen string, cod_div_destino string, fec_aplicacion timestamp_ntz, pct_venta double, pct_compra double, pct_fixing double",
}
QUESTIONS = "n int, partner long, company string, purpose string, direct string, f string, t string, moment timestamp_ntz, kind string, amount double"


def data(rng: random.Random) -> dict[str, list[tuple]]:
    def when() -> datetime:
        return START + timedelta(hours=rng.randrange(0, 9000))

    def pair() -> tuple[str, str]:
        other = rng.choice(CURRENCIES[1:])
        return ("USD", "GBP") if rng.random() < 0.1 else (other, "EUR") if rng.random() < 0.5 else ("EUR", other)

    return {
        "partner_rate": list({(p, *pair(), when()): None for _ in range(5) for p in (1, 2)}),
        "type_rate": list({(f"T{k}", *pair(), when()): None for _ in range(6) for k in (0, 1)}),
        "daily_rate": list({(date(2015, 1, 1) + timedelta(days=rng.randrange(300)), rng.choice(CURRENCIES[1:])): None for _ in range(400)}),
        "company_rate_type": list({(f"E{k}", when()): None for _ in range(5) for k in (0, 1)}),
        "spread": list({(f"T{k}", *pair(), when()): None for _ in range(30) for k in (0, 1)}),
    }


def filled(rng: random.Random, rows: dict[str, list[tuple]]) -> dict[str, list[tuple]]:
    numbers = {"partner_rate": 1, "type_rate": 1, "daily_rate": 1, "spread": 3}
    out = {name: [(*r, *[rng.randrange(1, 99) / 7 for _ in range(n)]) for r in rows[name]] for name, n in numbers.items()}
    out["company_rate_type"] = [(*r, *[f"T{rng.randrange(3)}" for _ in range(4)]) for r in rows["company_rate_type"]]
    return out


def plain_pair(rows: list[tuple], scope, f: str, t: str, at: datetime):
    """Latest of the stored pairs and inverses; the stored one wins a tie, then the larger rate."""
    found = [(r[3], 2, r[4]) for r in rows if r[:3] == (scope, f, t) and r[3] <= at]
    found += [(r[3], 1, 1 / r[4]) for r in rows if r[:3] == (scope, t, f) and r[3] <= at]
    return max(found)[2] if found else None


def plain_leg(d, partner, kind, f, t, at):
    if partner is not None and (rate := plain_pair(d["partner_rate"], partner, f, t, at)) is not None:
        return rate, "partner"
    if kind is not None and (rate := plain_pair(d["type_rate"], kind, f, t, at)) is not None:
        return rate, "type"
    day = {(r[0], r[1]): r[2] for r in d["daily_rate"]}
    if t == "EUR" and (at.date(), f) in day:
        return day[at.date(), f], "daily"
    if f == "EUR" and (at.date(), t) in day:
        return 1 / day[at.date(), t], "daily"
    return None


def plain_answer(d, partner, company, purpose, direct, f, t, at):
    """(rate, source, type, reason)"""
    if f is None:
        return None, None, None, "no source currency"
    if t is None:
        return None, None, None, "no target currency"
    if f == t:
        return 1.0, "same", None, None
    if at is None:
        return None, None, None, "no date"
    if partner is None and direct is None:
        if company is None:
            return None, None, None, "no company"
        if purpose not in ("R", "C", "L", "A"):
            return None, None, None, "unknown purpose"
    later = [r for r in d["company_rate_type"] if r[0] == company and r[1] >= at]
    kind = direct
    if kind is None and later and purpose in ("R", "C", "L", "A"):
        kind = min(later, key=lambda r: r[1])[2 + "RCLA".index(purpose)]
    found = plain_leg(d, partner, kind, f, t, at)
    if found is None and "EUR" not in (f, t):
        a, b = plain_leg(d, partner, kind, f, "EUR", at), plain_leg(d, partner, kind, "EUR", t, at)
        found = (a[0] * b[0], f"{a[1]}+{b[1]}") if a and b else None
    return (*(found or (None, None)), kind, None)


def questions(rng: random.Random, n: int) -> list[tuple]:
    out = []
    for i in range(n):
        at = START + timedelta(hours=rng.randrange(-500, 9500))
        row = (
            rng.choice([1, 1, 2, 3, None]), rng.choice(["E0", "E1", "E9", None]), rng.choice(["R", "C", "L", "A", "Z", None]),
            rng.choice([None, None, None, "T0", "T7"]), rng.choice([*CURRENCIES, None]), rng.choice([*CURRENCIES, None]),
            rng.choice([at, at, at, at, None]), rng.choice(["V", "C", "F", None]), rng.choice([1.0, -3.5, 0.0, None]),
        )
        out.append((i, *row))
    return out


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(11)
    rows = filled(rng, data(rng))
    tables = {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}
    return rows, tables, questions(rng, 500)


ASKED = Asked("fx", "f", "t", "moment", "partner", "company", "purpose", "direct")


@pytest.mark.parametrize("within", [(), ("n",), ("half",)])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_chain_against_plain_python(spark, world, broadcast, within):
    rows, tables, asked = world
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        frame = spark.createDataFrame(asked, QUESTIONS).withColumn("half", F.expr("n div 2"))
        found = attach_rates(frame, [ASKED], rate_sources(tables), details=True, within=within).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == len(asked)
    sources = set()
    for r in found:
        rate, source, kind, reason = plain_answer(rows, r.partner, r.company, r.purpose, r.direct, r.f, r.t, r.moment)
        assert (r.fx_source, r.fx_type, r.fx_reason) == (source, kind, reason), r
        assert r.fx == (rate if rate is None else pytest.approx(rate, rel=1e-12))
        sources.add(source)
    assert {"partner", "type", "daily", "same", None} <= sources
    assert {"partner+partner", "partner+type", "daily+daily"} & sources and len(sources) > 8


def test_amounts_with_spread_and_rounding(spark, world):
    rows, tables, asked = world
    currencies = spark.createDataFrame([("EUR", 2), ("USD", 2), ("GBP", 3), ("JPY", 0)], "cod_divisa string, decimales int")
    frame = spark.createDataFrame(asked, QUESTIONS)
    for rounded in (True, False):
        found = full_exchange(frame, rate_sources(tables), currencies, ASKED, "amount", "kind", "out", rounded).collect()
        for r in found:
            rate, _, kind, _ = plain_answer(rows, r.partner, r.company, r.purpose, r.direct, r.f, r.t, r.moment)
            if r.amount is None or rate is None:
                assert r.out is None
                continue
            pct = 0.0
            if r.f != r.t and r.kind is not None:
                held = [s for s in rows["spread"] if s[:3] == (kind, r.f, r.t) and s[3] <= r.moment]
                pct = max(held, key=lambda s: s[3])[4 + "VCF".index(r.kind)] if held else 0.0
            value = r.amount if r.f == r.t else r.amount * rate * (1 + pct / 100)
            digits = {"EUR": 2, "USD": 2, "GBP": 3, "JPY": 0}.get(r.t) if rounded else None
            assert float(r.out) == pytest.approx(value, abs=0.5 * 10.0**-digits + 1e-6 if digits is not None else 1e-6)


def test_partner_decides_a_measures_rate(spark):
    """Two partners with different rates for one pair and date."""
    rates = [(1, "USD", "EUR", START, 0.5), (2, "USD", "EUR", START, 0.8)]
    tables = {"partner_rate": spark.createDataFrame(rates, SCHEMAS["partner_rate"])}
    rows = spark.createDataFrame(
        [(1, "USD", START), (2, "USD", START), (3, "USD", START), (None, "USD", START), (None, "EUR", START)],
        "partner_ttoo long, ccy string, at timestamp_ntz",
    ).withColumn("rate_company", F.lit("E0"))
    found = FullConverter(rate_sources(tables))(rows, "ccy", None, "at", "rate").collect()
    assert {(r.partner_ttoo, r.ccy): r.rate for r in found} == {
        (1, "USD"): 0.5, (2, "USD"): 0.8, (3, "USD"): None, (None, "USD"): None, (None, "EUR"): 1.0,
    }


def test_no_sources_at_all(spark):
    tables = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    frame = spark.createDataFrame(questions(random.Random(3), 40), QUESTIONS)
    found = attach_rates(frame, [ASKED], rate_sources(tables)).collect()
    assert len(found) == 40 and all(r.fx == (1.0 if r.f == r.t and r.f else None) for r in found)


def executed(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_of_the_rows_per_lookup(spark):
    """Without broadcasting, a lookup moves the rows once and joins once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rates = spark.range(1000).selectExpr("concat('hot', id % 1) AS k", "timestamp_ntz'2015-01-01' + make_dt_interval(CAST(id AS INT)) AS eff", "id AS v")
        rows = spark.range(5000).selectExpr("id AS n", "concat('hot', id % 1) AS k", "timestamp_ntz'2015-01-01' + make_dt_interval(CAST(id % 1000 AS INT), 3) AS at")
        prepared = intervals(rates, ["k"], "eff")
        found = asof_lookup(rows, prepared, {"k": "k"}, "at", {"v": "out"})
        text = executed(found)
        assert text.count("Join") == 1 and text.count("Exchange hashpartitioning") == 3  # rows, window, intervals
        assert found.filter("out <> n % 1000").count() == 0
        # One key holds all rows; its cells spread them over the tasks.
        places = found.groupBy(F.pmod(F.hash("k", prepared.grid.cell(F.col("at"))), F.lit(8))).count().collect()
        assert len(places) == 8 and max(r["count"] for r in places) < 2 * 5000 / 8
        forward = asof_lookup(rows, intervals(rates, ["k"], "eff", FORWARD), {"k": "k"}, "at", {"v": "out"})
        assert forward.filter("n % 1000 < 999 AND out <> n % 1000 + 1 OR n % 1000 = 999 AND out IS NOT NULL").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_small_history_of_large_tables_moves_no_rows(spark):
    """Daily rates are a few rows, though summed up from a table far over the broadcast limit."""
    rates = spark.range(5_000_000).selectExpr(
        "date'2015-01-01' + CAST(id % 200 AS INT) AS date", "concat('C', id % 3) AS currency", "CAST(1 + id % 3 AS DOUBLE) AS rate"
    )
    tables = {"partner_rate": spark.createDataFrame([], SCHEMAS["partner_rate"]), "daily_rate": rates}
    rows = spark.range(3000).selectExpr(
        "id AS grec_seq_rec", "id AS seq_reserva", "1L AS partner_ttoo", "'E0' AS rate_company", "concat('C', id % 3) AS ccy",
        "timestamp_ntz'2015-01-01' + make_dt_interval(CAST(id % 200 AS INT), 5) AS at",
    )
    found = FullConverter(rate_sources(tables))(rows, "ccy", None, "at", "rate")
    assert "scope" not in "".join(re.findall(r"Exchange hashpartitioning\([^\n]*", executed(found)))
    assert found.filter("rate = 1 + seq_reserva % 3").count() == 3000


def test_rejects_are_split_from_one_run(spark, world, tmp_path):
    rows, tables, asked = world
    frame = spark.createDataFrame(asked, QUESTIONS)
    good, bad = split_rejects(frame, ASKED, f"file://{tmp_path}/requests")
    reasons = {r.n: r.reason for r in bad.collect()}
    want = {a[0]: plain_answer(rows, *a[1:8])[3] for a in asked}
    assert reasons == {n: reason for n, reason in want.items() if reason}
    assert {r.n for r in good.collect()} == {n for n, reason in want.items() if not reason}
    assert good.columns == frame.columns
