"""Measures on hand-built bookings; at creation 1 USD = 0.25 EUR, later 0.75."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from fixtures import NO_TAX, booking, component, day, line, tables

from staymart.operators.exchange import asof_converter
from staymart.operators import lookups
from staymart.operators.exclusion import campaign_exclusion
from staymart.plans import extract, header, measures, rollup, transfer
from staymart.sources.catalog import SCHEMAS


def sale_measures(spark, wanted, **rows):
    t = tables(spark, **rows)
    sale = rollup.rollup_lines(t["sale"], t["tax"], explicit_tax=True)
    result = measures.booking_measures(t, sale, wanted, asof_converter(t["partner_rate"]))
    return {r["seq_reserva"]: r.asDict() for r in result.collect()}


def cost_measures(spark, wanted, **rows):
    t = tables(spark, **rows)
    exclusion = campaign_exclusion(t["extra"], t["discount_bond"], t["campaign"])
    cost = rollup.rollup_lines(t["cost"], t["tax"], "sdiv_cod_divisa", exclusion=exclusion)
    result = measures.booking_measures(t, cost, wanted, asof_converter(t["partner_rate"]))
    return {r["seq_reserva"]: r.asDict() for r in result.collect()}


def test_ttv_by_payment_mode(spark):
    def lines(number):
        return [
            line(number, "H", 100),
            line(number, "CH", 10),
            line(number, "H", 1, ind_facturable="N"),
            line(number, "O", 1000),
            line(number, "H", 5000, ind_contra_apunte="S"),
        ]

    found = sale_measures(
        spark,
        measures.TTV,
        booking=[booking(1), booking(2, ind_tippag="H"), booking(3)],
        sale=lines(1) + lines(2),
    )
    assert float(found[1]["TTV_booking_currency"]) == 110
    assert float(found[1]["TTV_EUR_currency"]) == 27.5
    assert float(found[2]["TTV_booking_currency"]) == 101
    assert float(found[3]["TTV_booking_currency"]) == 0
    assert float(found[3]["TTV_EUR_currency"]) == 0


def test_sale_tax_regimes(spark):
    found = sale_measures(
        spark,
        [*measures.TAX_TTV, *measures.TAX_TTV_TOMS],
        sale=[
            line(10, "H", 110),
            line(10, "H", 110, imp_impuesto=3),
            line(10, "BT", 110, imp_impuesto=50),
            line(10, "H", 110, ind_tipo_regimen="E", ind_trfprc="N"),
            line(10, "H", 110, ind_tipo_regimen="E", ind_trfprc="S"),
            line(10, "H", 110, **NO_TAX),
            line(10, "V", 110),
        ],
    )[10]
    assert float(found["tax_ttv"]) == 23
    assert float(found["tax_ttv_toms"]) == 10
    assert float(found["tax_ttv_eur"]) == 5.75


def test_commission_rounds_the_unit_tax_first(spark):
    found = sale_measures(
        spark,
        [*measures.CLIENT_COMMISSION, *measures.CLIENT_RAPPEL],
        booking=[booking(10), booking(11, gdiv_cod_divisa="GBP"), booking(12, gdiv_cod_divisa="X")],
        sale=[
            line(n, kind, 0.17, nro_unidades=1000) for n in (10, 11, 12) for kind in ("O", "V", "D")
        ],
    )
    # Unit tax 0.0154545: 0.02 in USD, 0 in GBP, unrounded in an unknown currency.
    assert float(found[10]["Tax_Client_commision"]) == 20
    assert float(found[10]["Client_Commision"]) == 340
    assert float(found[10]["client_rappel"]) == 170
    assert float(found[11]["tax_client_rappel"]) == 0
    assert abs(float(found[12]["tax_client_rappel"]) - 15.454545) < 1e-5
    # No rate from X to the euro: no total either.
    assert found[12]["Client_EUR_rappel"] is None
    assert float(found[12]["client_rappel"]) == 170


def test_sale_lines_are_in_the_booking_currency(spark):
    found = sale_measures(
        spark,
        measures.CLIENT_COMMISSION,
        booking=[booking(10), booking(11, gdiv_cod_divisa="GBP")],
        sale=[line(10, "O", 100), line(11, "O", 100)],
    )
    assert "gdiv_cod_divisa" not in SCHEMAS["sale"][1]
    assert float(found[10]["Client_Commision"]) == 100
    assert float(found[11]["Client_Commision"]) == 100
    # USD at 0.25 on creation, GBP at 2.
    assert float(found[10]["Client_EUR_Commision"]) == 25
    assert float(found[11]["Client_EUR_Commision"]) == 200


def test_amounts_without_a_rate_are_not_lost(spark):
    t = tables(
        spark,
        booking=[booking(10), booking(11)],
        cost=[
            line(10, "H", 100),
            line(10, "H", 40, sdiv_cod_divisa="X"),
            line(10, "H", 0, sdiv_cod_divisa="Y"),
            line(11, "H", 100),
            line(11, "H", 0, sdiv_cod_divisa="X"),
        ],
    )
    cost = rollup.rollup_lines(t["cost"], t["tax"], "sdiv_cod_divisa")
    convert = asof_converter(t["partner_rate"])
    header = measures.measure_header(t["booking"], t["interface"], t["currency"], measures.COST)

    def totals(**options):
        rows = measures.fold(header, cost, measures.COST, convert, **options).collect()
        return {r["seq_reserva"]: r["cost_eur_currency"] for r in rows}

    assert totals()[10] is None and float(totals()[11]) == 25
    assert float(totals(unrated="skip")[10]) == 25
    with pytest.raises(Exception, match="no rate for booking"):
        totals(unrated="raise")
    missing = measures.unrated_amounts(header, cost, measures.COST, convert).collect()
    found = {(r["measure"], r["currency"]): (r["n_bookings"], float(r["amount"])) for r in missing}
    assert found["cost_eur_currency", "X"] == (1, 40)
    assert not any(currency == "Y" for _, currency in found)
    # Converted and unrated amounts make up all lines.
    assert 25 / 0.25 + 40 == 140


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_amounts_are_exact_or_fail(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = sale_measures(
            spark, measures.TTV, booking=[booking(10)],
            sale=[line(10, "H", 100_000_000_000, nro_unidades=20), line(10, "H", 5)],
        )
        assert found[10]["TTV_booking_currency"] == 2_000_000_000_005
        with pytest.raises(Exception, match="amount too large"):
            sale_measures(
                spark, measures.TTV, booking=[booking(10)],
                sale=[line(10, "H", 100_000_000_000, nro_unidades=200)],
            )
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_repeated_lookup_rows_multiply_nothing(spark):
    t = dict(
        tables(
            spark,
            booking=[booking(n) for n in (10, 11)],
            sale=[line(n, "O", 100) for n in (10, 11)],
            resale=[{"seq_rec": 1, "seq_reserva": 10, "ind_status": "RR"}],
        )
    )
    convert = asof_converter(t["partner_rate"])
    once = {r["booking_id"]: r for r in extract.full_extract(t, convert).collect()}
    for name in ("currency", "interface", "receptive", "resale", "ttoo", "country", "daily_rate"):
        t[name] = t[name].union(t[name])
    twice = extract.full_extract(t, convert).collect()
    assert len(twice) == 2
    assert all(r == once[r["booking_id"]] for r in twice)


def test_not_in_drops_what_it_cannot_tell(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (1, None), (2, 1), (2, None)], "a int, b int")
    keys = spark.createDataFrame([(1, 1)], "x int, y int")
    on = {"a": "x", "b": "y"}
    assert sorted(tuple(r) for r in lookups.exclude_keys(rows, keys, on).collect() if r.b) == [(1, 2), (2, 1)]
    found = lookups.exclude_keys_not_in(rows, keys, on, "b").collect()
    assert sorted(map(str, (tuple(r) for r in found))) == ["(1, 2)", "(2, 1)", "(2, None)"]
    assert lookups.exclude_keys_not_in(rows, keys.where("false"), on, "b").count() == 5


def test_cost_and_hotel_payment(spark):
    found = cost_measures(
        spark,
        [*measures.COST, *measures.HOTEL_PAYMENT],
        booking=[booking(10), booking(11, ind_tippag="H")],
        cost=[
            line(n, kind, 11, ind_facturable=flag)
            for n in (10, 11)
            for kind in ("CH", "SC", "PF", "L")
            for flag in ("S", "N")
        ],
    )
    assert float(found[10]["cost_booking_currency"]) == 22  # CH and L
    assert float(found[11]["cost_booking_currency"]) == 44
    assert float(found[10]["tax_cost"]) == 3  # SC is taxed
    assert float(found[11]["tax_cost"]) == 6
    for number in (10, 11):
        assert float(found[number]["Platform_Fee"]) == 11
        assert float(found[number]["Tax_Platform_fee"]) == 1
        assert float(found[number]["Withholding_EUR"]) == 2.75
        assert float(found[number]["Local_Levy"]) == 0


CAMPAIGN = dict(
    extra=[
        dict(grec_seq_rec=1, rres_seq_reserva=10, ord_extra=1, num_bono=5, cod_interface="I1"),
        dict(grec_seq_rec=1, rres_seq_reserva=10, ord_extra=2, num_bono=6, cod_interface="I1"),
        dict(grec_seq_rec=1, rres_seq_reserva=10, ord_extra=3, num_bono=None, cod_interface="I1"),
    ],
    discount_bond=[
        dict(num_bono=5, cod_interface="I1", cod_campana="K1"),
        dict(num_bono=6, cod_interface="I1", cod_campana="K2"),
    ],
    campaign=[
        dict(cod_campana="K1", cod_interface="I1", ind_rentabilidad="N"),
        dict(cod_campana="K2", cod_interface="I1", ind_rentabilidad="S"),
    ],
)


def priced(spark, **rows):
    t = tables(spark, **rows)
    exclusion = campaign_exclusion(t["extra"], t["discount_bond"], t["campaign"])
    components = rollup.rollup_components(extract.component_table(t), t["tax"], exclusion)
    cost = rollup.rollup_lines(t["cost"], t["tax"], "sdiv_cod_divisa", exclusion=exclusion)
    result = transfer.transfer_pricing(t, components, cost, asof_converter(t["partner_rate"]))
    return {r["seq_reserva"]: r.asDict() for r in result.collect()}, components


def test_transfer_pricing(spark):
    found, components = priced(
        spark,
        booking=[booking(10), booking(11)],
        canco_hotel=[component(10)],
        canco_other=[component(10)],  # equal subtotal, counted twice
        canco_transfer=[component(10, cod_impuesto_vta_fac="none")],
        canco_extra=[component(10, ord_extra=n) for n in (1, 2, 3)],
        cost=[
            line(10, "DR", 100, rext_ord_extra=1),
            line(10, "DR", 10, rext_ord_extra=2),
            line(10, "DR", 1, ind_contra_apunte="S"),
            line(10, "DR", 1000, ind_facturable="N"),
            line(11, "DR", 4, rext_ord_extra=1),
        ],
        **CAMPAIGN,
    )
    # Four components count: canal tax 1, canco tax 2 each; recharge 11; rate 0.25.
    assert float(found[10]["Tax_Sales_Transfer_pricing"]) == 4
    assert float(found[10]["Transfer_pricing"]) == 4 + 2 + 11
    assert float(found[10]["Tax_Cost_Transfer_pricing"]) == 8 + 11
    assert float(found[10]["Tax_Sales_Transfer_pricing_EUR"]) == 1
    assert float(found[10]["Tax_Transfer_pricing_EUR"]) == 1 + 2 + 2.75
    assert float(found[10]["Tax_Cost_Transfer_pricing_EUR"]) == 2 + 2.75
    # No components: the recharge is still added, once.
    assert float(found[11]["Transfer_pricing"]) == 4
    assert float(found[11]["Tax_Sales_Transfer_pricing"]) == 0
    # Set-union reading: hotel and other give 1 each and count once, extra gives 2.
    distinct = transfer.distinct_subtotals(components, "canal", "v").collect()
    assert [float(r["v"]) for r in distinct] == [3.0]


def test_component_regimes(spark):
    found, _ = priced(
        spark,
        canco_hotel=[component(10, ind_tipo_regimen_fac="G", ind_tipo_regimen_con="G")],
    )
    # canal (110 - 99) / 11, canco (77 - 55) / 11
    assert float(found[10]["Tax_Sales_Transfer_pricing"]) == 1
    assert float(found[10]["Tax_Cost_Transfer_pricing"]) == 2


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_hot_booking(spark, threshold):
    """A third of the lines in one booking, with and without broadcast joins."""
    rng = random.Random(3)
    lines, expected = [], defaultdict(Decimal)
    for i in range(3000):
        number = 10 if i % 3 == 0 else rng.randrange(11, 400)
        amount = Decimal(rng.randrange(1, 10**6)) / 100
        lines.append(line(number, "H", amount))
        expected[number] += amount
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = sale_measures(
            spark, measures.TTV[:1], booking=[booking(n) for n in range(10, 400)], sale=lines
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {n: r["TTV_booking_currency"] for n, r in found.items()} == {
        n: expected[n] for n in range(10, 400)
    }


def test_destination_prefers_the_first_named_hotel_then_a_valid_contract(spark):
    other = dict(
        seq_rec=1, nom_contrato="CT", ind_tipo_otro="T", fec_desde=day("2017-05-01T00:00:00")
    )
    t = tables(
        spark,
        booking=[booking(n) for n in (1, 2, 3)],
        hotel_sale=[
            dict(grec_seq_rec=1, rres_seq_reserva=1, ghor_seq_hotel=h) for h in (9, 4, 3)
        ],
        hotel=[
            dict(seq_hotel=9, izge_cod_destino="PMI"),
            dict(seq_hotel=4, izge_cod_destino="BCN"),
            dict(seq_hotel=3, izge_cod_destino="XXX"),
        ],
        destination=[
            dict(ides_cod_destino=c, sidi_cod_idioma=lang, nom_destino=f"{c} {lang}")
            for c in ("PMI", "BCN")
            for lang in ("ENG", "ESP")
        ],
        other=[{**other, "seq_reserva": 2}, {**other, "seq_reserva": 3, "nom_contrato": "OLD"}],
        contract_other=[
            dict(
                seq_rec=1,
                nom_contrato=name,
                ind_tipo_otro="T",
                cod_destino="PMI",
                fec_desde=day("2017-01-01"),
                fec_hasta=day(end),
            )
            for name, end in (("CT", "2017-05-01"), ("OLD", "2017-04-30"))
        ],
    )
    found = header.destination_code(
        t["booking"], t["hotel_sale"], t["hotel"], t["destination"], t["other"],
        t["contract_other"],
    )
    assert {r["seq_reserva"]: r["Destination_code"] for r in found.collect()} == {
        1: "BCN-BCN ENG",
        2: "PMI-PMI ENG",
        3: "NO_DESTINATION_CODE",
    }


def test_full_extract_keeps_one_row_per_booking(spark):
    t = tables(
        spark,
        booking=[
            booking(1, cod_pais_cliente="UK"),
            booking(2, fec_cancelacion=day("2017-04-01T08:00:00"), seq_rec_hbeds=99),
            booking(3, gtto_seq_ttoo=None),
        ],
        sale=[line(1, "H", 100), line(1, "H", 50)],
        booking_information=[
            dict(seq_rec=1, seq_reserva=1, fec_creacion=day(at), tipo_op=op, aplicacion=app)
            for at, op, app in (
                ("2017-03-11", "A", "WEB"),
                ("2017-03-09", "M", "OLD"),
                ("2017-03-10", "A", "XML"),
            )
        ],
        hotel_sale=[
            dict(grec_seq_rec=1, rres_seq_reserva=1, ghor_seq_hotel=1),
            dict(
                grec_seq_rec=1, rres_seq_reserva=1, ghor_seq_hotel=2,
                fec_cancelacion=day("2017-04-01"),
            ),
        ],
    )
    rows = extract.full_extract(t, asof_converter(t["partner_rate"])).collect()
    found = {r["seq_reserva"]: r.asDict() for r in rows}
    assert set(found) == {1, 2}  # booking 3 has no client
    first, second = found[1], found[2]
    assert first["interface_id"] == "1-1"
    assert first["source_market_iso"] == "GBR" and second["source_market_iso"] == "ESP"
    assert first["holder"] == "DoeJo"
    assert first["first_booking_ts"] == day("2017-03-10") and first["Application"] == "XML"
    assert first["NUMBER_ACTIVE_ACC_SERV"] == 1 and second["NUMBER_ACTIVE_ACC_SERV"] == 0
    assert first["invoicing_company"] == "E2" and second["invoicing_company"] is None
    assert second["cancelled_booking"] == "S"
    assert second["cancellation_ts"] == "2017-04-01 08:00:00"
    assert float(first["TTV_EUR_currency"]) == 37.5


def test_restricted_run_equals_the_full_run_on_its_window(spark):
    t = tables(
        spark,
        booking=[booking(n, fec_creacion=day(f"2017-03-{n:02d}T12:00:00")) for n in range(1, 9)],
        sale=[line(n, "H", 10 * n) for n in range(1, 9)],
    )
    from staymart.sources.catalog import date_window

    window = date_window(t["booking"], "2017-03-03", "2017-03-05")
    cut = extract.restrict_tables(t, window)
    convert = asof_converter(t["partner_rate"])
    whole = {r["seq_reserva"]: r for r in extract.full_extract(t, convert).collect()}
    part = {r["seq_reserva"]: r for r in extract.full_extract(cut, convert).collect()}
    assert set(part) == {3, 4}
    assert all(part[n] == whole[n] for n in part)
    assert cut["sale"].count() == 2
