"""Oracle SQL, written against the derived tables in the plain join-then-filter shape."""

from __future__ import annotations

import re

from workload.tables import HOTEL_PAY_TABLES, oracle_definitions

# --- fixed values: record type -> output names ---
HOTEL_PAY = {
    "CA": (
        "Agency_commision_hotel_payment",
        "Tax_Agency_commision_hotel_pay",
        "agency_comm_hotel_pay_eur",
        "tax_agency_comm_hotel_pay_eur",
    ),
    "OC": (
        "Fix_override_hotel_payment",
        "Tax_Fix_override_hotel_pay",
        "fix_override_hotel_pay_eur",
        "tax_fix_overr_hotel_pay_eur",
    ),
    "OV": (
        "Var_override_hotel_payment",
        "Tax_Var_override_hotel_pay",
        "var_override_hotel_pay_eur",
        "Tax_Var_override_hotel_pay_EUR",
    ),
    "CH": (
        "Hotel_commision_hotel_payment",
        "Tax_Hotel_commision_Hotel_pay",
        "hotel_commision_hotel_pay_eur",
        "tax_hotel_comm_hotel_pay_eur",
    ),
    "L": (
        "Marketing_contribution",
        "Tax_marketing_contribution",
        "Marketing_contribution_EUR",
        "Tax_marketing_contribution_EUR",
    ),
    "K": (
        "bank_expenses",
        "Tax_Bank_expenses",
        "bank_expenses_EUR",
        "Tax_Bank_expenses_EUR",
    ),
    "PF": ("Platform_Fee", "Tax_Platform_fee", "Platform_Fee_EUR", "Tax_Platform_fee_EUR"),
    "CT": (
        "credit_card_fee",
        "Tax_credit_card_fee",
        "credit_card_fee_EUR",
        "Tax_credit_card_fee_EUR",
    ),
    "SC": ("Withholding", "Tax_withholding", "Withholding_EUR", "Tax_withholding_EUR"),
    "LL": ("Local_Levy", "Tax_Local_Levy", "Local_Levy_EUR", "Tax_Local_Levy_EUR"),
    "I": (
        "Partner_Third_commision",
        "Tax_partner_third_commision",
        "partner_third_comm_eur",
        "tax_partner_third_comm_eur",
    ),
}
# --- end of fixed values ---


def _days(alias: str = "l") -> str:
    return (
        f"CASE {alias}.ind_tipo_unid "
        f"WHEN 'N' THEN date_diff('day', CAST({alias}.fec_desde AS DATE), CAST({alias}.fec_hasta AS DATE)) "
        f"WHEN 'S' THEN date_diff('day', CAST({alias}.fec_desde AS DATE), CAST({alias}.fec_hasta AS DATE)) + 1 "
        "ELSE 1 END"
    )


def _amount(unit: str, alias: str = "l", days: str | None = None) -> str:
    days = days or _days(alias)
    quantity = (
        f"CASE {alias}.ind_p_s WHEN 'P' THEN {alias}.nro_pax ELSE {alias}.nro_unidades END"
    )
    return (
        f"CASE WHEN {alias}.fec_desde IS NULL OR {alias}.fec_hasta IS NULL THEN 0.0 "
        f"ELSE CAST({unit} AS DOUBLE) * (({days}) * ({quantity})) END"
    )


def _dec(value: str) -> str:
    """A double in whole millionths, to the nearest, as a decimal."""
    return (
        f"(CAST(CAST(round_even(({value}) * 1000000, 0) AS BIGINT) AS DECIMAL(19,0)) "
        "* CAST(0.000001 AS DECIMAL(7,6)))"
    )


def _round(value: str, decimals: str) -> str:
    arms = " ".join(
        f"WHEN {k} THEN CAST(round({_dec(value)}, {k}) AS DOUBLE)"
        for k in range(6)
    )
    return f"CASE {decimals} {arms} ELSE CAST({value} AS DOUBLE) END"


UNIT_TAX = "(l.imp_unitario - l.imp_unitario / (1 + x.pct_impuesto / 100))"

TAX_JOIN = """LEFT JOIN tax x ON l.rvp_ind_tipo_imp = x.ind_tipo_imp
    AND l.rvp_cod_impuesto = x.cod_impuesto AND l.rvp_cod_esquema = x.cod_esquema
    AND l.rvp_cod_clasif = x.cod_clasif AND l.rvp_cod_empresa = x.cod_emp_atlas"""
COMPONENT_TAX_JOIN = """JOIN tax {a} ON l.ind_tipo_imp_vta_fac = {a}.ind_tipo_imp
    AND l.cod_impuesto_vta_fac = {a}.cod_impuesto AND l.cod_esquema_vta_fac = {a}.cod_esquema
    AND l.cod_clasif_vta_fac = {a}.cod_clasif AND l.cod_empresa_vta_fac = {a}.cod_emp_atlas"""
BOOKING_LINE = "b.grec_seq_rec = l.grec_seq_rec AND b.seq_reserva = l.rres_seq_reserva"
PAYABLE = (
    "((b.ind_tippag IS NULL AND l.ind_facturable = 'S') "
    "OR (b.ind_tippag IS NOT NULL AND l.ind_tipo_registro <> 'CH'))"
)
NORMAL = "l.ind_contra_apunte = 'N'"
REGIME = "l.ind_tipo_regimen || coalesce(l.ind_trfprc, 'N')"
SALE_TAX = f"coalesce({_dec('l.imp_impuesto')}, {_dec(_amount(UNIT_TAX))})"


def _unrated(amount: str, rate: str, value: str) -> str:
    """Null where an amount has no rate."""
    return f"CASE WHEN bool_or({amount} <> 0 AND {rate} IS NULL) THEN NULL ELSE {value} END"


def _priced(amount: str, rate: str) -> str:
    """Sum of converted subtotals, 0 for none, null if one has no rate."""
    value = f"CAST(coalesce(sum({_dec(f'CAST({amount} AS DOUBLE) * {rate}')}), 0) AS DOUBLE)"
    return _unrated(amount, rate, value)


def _priced_total(amount: str, rate: str) -> str:
    """Converted total, for a rate that is one per booking."""
    value = (
        f"CAST(coalesce({_dec(f'CAST(sum({amount}) AS DOUBLE) * max({rate})')}, 0) "
        "AS DOUBLE)"
    )
    return _unrated(amount, rate, value)


def _plain(amount: str) -> str:
    return f"CAST(coalesce(sum({amount}), 0) AS DOUBLE)"


def _only(condition: str, amount: str) -> str:
    return f"CASE WHEN {condition} THEN {amount} END"


def _fx_requests() -> str:
    wanted = [
        ("l.sdiv_cod_divisa", "b.gdiv_cod_divisa", "b.policy_date", "cost"),
        ("l.sdiv_cod_divisa", "b.gdiv_cod_divisa", "b.fec_creacion", "cost"),
        ("l.sdiv_cod_divisa", "'EUR'", "b.fec_creacion", "cost"),
    ]
    who = "partner_ttoo AS p, rate_company AS c, 'R' AS purpose, CAST(NULL AS VARCHAR) AS direct"
    parts = [
        f"SELECT {who}, {a} AS f, {z} AS t, {at} AS moment FROM hdr b JOIN {table} l ON {BOOKING_LINE}"
        for a, z, at, table in wanted
    ]
    parts += [
        f"SELECT {who}, gdiv_cod_divisa, 'EUR', fec_creacion FROM hdr",
        f"SELECT {who}, cod_divisa_p, gdiv_cod_divisa, policy_date FROM hdr",
        f"SELECT {who}, cod_divisa_p, 'EUR', fec_creacion FROM hdr",
    ]
    return "\nUNION\n".join(parts)


def _leg(number: int, f: str, t: str) -> str:
    """Joins of one leg: the partner's rate, the type's, the day's."""
    n = number
    pair = f"{f} = {{0}}{n}.f AND {t} = {{0}}{n}.t"
    return f"""ASOF LEFT JOIN candidate p{n} ON 'P' || q.p = p{n}.scope AND {pair.format("p")} AND q.moment >= p{n}.since
ASOF LEFT JOIN candidate t{n} ON 'T' || q.ty = t{n}.scope AND {pair.format("t")} AND q.moment >= t{n}.since
LEFT JOIN day_rate d{n} ON {pair.format("d")} AND CAST(q.moment AS DATE) = d{n}.day"""


def _leg_source(n: int) -> str:
    return (
        f"CASE WHEN p{n}.rate IS NOT NULL THEN 'partner' WHEN t{n}.rate IS NOT NULL THEN 'type' "
        f"WHEN d{n}.rate IS NOT NULL THEN 'daily' END"
    )


def _answers(requests: str) -> str:
    """The whole chain for (p, c, purpose, direct, f, t, moment): rate, type, source."""
    ways = [f"coalesce(p{n}.rate, t{n}.rate, d{n}.rate)" for n in range(3)]
    via = f"{ways[1]} * {ways[2]}"
    return f"""SELECT q.* EXCLUDE (e),
    CASE WHEN q.f = q.t THEN 1.0 ELSE coalesce({ways[0]}, {via}) END AS rate,
    CASE WHEN q.f = q.t THEN 'same' ELSE coalesce({_leg_source(0)},
        {_leg_source(1)} || '+' || {_leg_source(2)}) END AS source
FROM (SELECT r.*, 'EUR' AS e, coalesce(r.direct, CASE r.purpose WHEN 'R' THEN h.tipo_cambio_rex
        WHEN 'C' THEN h.tipo_cambio_caj WHEN 'L' THEN h.tipo_cambio_liq
        WHEN 'A' THEN h.tipo_cambio_ctb END) AS ty
    FROM {requests} r ASOF LEFT JOIN company_rate_type h
        ON r.c = h.semp_cod_emp AND r.moment <= h.fec_aplicacion) q
{_leg(0, "q.f", "q.t")}
{_leg(1, "q.f", "q.e")}
{_leg(2, "q.e", "q.t")}"""


def _asof(requests: str, history: str, by: list[tuple[str, str]]) -> str:
    on = " AND ".join(f"q.{a} = h.{z}" for a, z in by)
    return (
        f"SELECT q.*, h.rate FROM ({requests}) q ASOF LEFT JOIN {history} h "
        f"ON {on} AND q.moment >= h.fec_desde"
    )


CTES: dict[str, str] = {
    **oracle_definitions(),
    # Stored pairs and their inverses; on one date the stored direction wins.
    "pair_rate": """SELECT seq_ttoo, f, t, fec_desde, rate FROM (
    SELECT *, row_number() OVER (PARTITION BY seq_ttoo, f, t, fec_desde ORDER BY pref, rate DESC) AS n
    FROM (
        SELECT seq_ttoo, cod_divisa_ori AS f, cod_divisa_des AS t, fec_desde, nro_tasa AS rate,
            1 AS pref FROM partner_rate
        UNION ALL
        SELECT seq_ttoo, cod_divisa_des, cod_divisa_ori, fec_desde, 1 / nro_tasa, 2
        FROM partner_rate) stored) ranked WHERE n = 1""",
    "any_rate": """SELECT f, t, fec_desde, rate FROM (
    SELECT *, row_number() OVER (PARTITION BY f, t, fec_desde ORDER BY pref, rate DESC) AS n
    FROM (
        SELECT cod_divisa_ori AS f, cod_divisa_des AS t, fec_desde, nro_tasa AS rate, 1 AS pref
        FROM partner_rate
        UNION ALL
        SELECT cod_divisa_des, cod_divisa_ori, fec_desde, 1 / nro_tasa, 2 FROM partner_rate
    ) stored) ranked WHERE n = 1""",
    "hdr": """SELECT b.grec_seq_rec, b.seq_reserva, b.fec_creacion, b.fec_desde,
    b.gdiv_cod_divisa, b.ind_tippag, b.cod_divisa_p, b.gtto_seq_ttoo, i.partner_ttoo,
    rf.semp_cod_emp AS rate_company,
    CASE WHEN i.ind_fec_cam_div = 'E' THEN b.fec_desde ELSE b.fec_creacion END AS policy_date,
    c.decimales,
    (SELECT max(decimales) FROM currency WHERE cod_divisa = 'EUR') AS decimales_eur
FROM booking b
LEFT JOIN interface i ON b.fint_cod_interface = i.cod_interface
LEFT JOIN receptive rf ON b.seq_rec_hbeds = rf.seq_rec
LEFT JOIN currency c ON b.gdiv_cod_divisa = c.cod_divisa""",
    "fx_request": _fx_requests(),
    # Stored pairs and inverses of all sources but the day's; on one date the stored one wins.
    "candidate": """SELECT scope, f, t, since, rate FROM (
    SELECT *, row_number() OVER (PARTITION BY scope, f, t, since ORDER BY pref, rate DESC) AS n
    FROM (
        SELECT 'P' || seq_ttoo AS scope, cod_divisa_ori AS f, cod_divisa_des AS t,
            fec_desde AS since, nro_tasa AS rate, 1 AS pref FROM partner_rate
        UNION ALL
        SELECT 'P' || seq_ttoo, cod_divisa_des, cod_divisa_ori, fec_desde, 1 / nro_tasa, 2
        FROM partner_rate
        UNION ALL
        SELECT 'T' || tipo_cambio, cod_div_origen, cod_div_destino, fec_aplicacion, nro_tasa, 1
        FROM type_rate
        UNION ALL
        SELECT 'T' || tipo_cambio, cod_div_destino, cod_div_origen, fec_aplicacion, 1 / nro_tasa, 2
        FROM type_rate) stored) ranked WHERE n = 1""",
    "day_rate": """SELECT date AS day, currency AS f, 'EUR' AS t, rate FROM daily_rate
    WHERE currency <> 'EUR'
UNION ALL SELECT date, 'EUR', currency, 1 / rate FROM daily_rate WHERE currency <> 'EUR'""",
    "fx_valid": """SELECT * FROM fx_request WHERE f = t OR p IS NOT NULL OR c IS NOT NULL""",
    "fx": _answers("fx_valid"),
    "excluded": """SELECT DISTINCT e.grec_seq_rec AS excl_seq_rec,
    e.rres_seq_reserva AS excl_seq_reserva, e.ord_extra AS excl_ord_extra
FROM extra e
JOIN discount_bond d ON e.num_bono = d.num_bono AND e.cod_interface = d.cod_interface
JOIN campaign c ON d.cod_campana = c.cod_campana AND d.cod_interface = c.cod_interface
WHERE c.ind_rentabilidad = 'N'""",
    "sale_sub": f"""SELECT b.grec_seq_rec AS rec, b.seq_reserva AS res, l.gdiv_cod_divisa AS ccy,
    l.ind_tipo_registro AS tipo,
    sum(CASE WHEN {PAYABLE} THEN {_dec(_amount("l.imp_unitario"))} END) AS gross,
    sum(CASE WHEN {PAYABLE} AND {REGIME} = 'GN' THEN {SALE_TAX} END) AS tax_gn,
    sum(CASE WHEN {PAYABLE} AND {REGIME} = 'EN' THEN {SALE_TAX} END) AS tax_en,
    sum(CASE WHEN l.ind_facturable = 'S' THEN {_dec(_amount("l.imp_unitario"))} END) AS billed,
    sum(CASE WHEN l.ind_facturable = 'S'
        THEN {_dec(_amount(_round(UNIT_TAX, "b.decimales")))} END) AS billed_tax
FROM hdr b JOIN sale l ON {BOOKING_LINE} {TAX_JOIN}
WHERE {NORMAL} GROUP BY b.grec_seq_rec, b.seq_reserva, l.gdiv_cod_divisa, l.ind_tipo_registro,
    l.ind_facturable = 'S', CASE WHEN {REGIME} IN ('GN', 'EN') THEN {REGIME} END""",
    "cost_sub": f"""SELECT b.grec_seq_rec AS rec, b.seq_reserva AS res, l.sdiv_cod_divisa AS ccy,
    l.ind_tipo_registro AS tipo,
    sum(CASE WHEN l.ind_facturable = 'S' OR b.ind_tippag IS NOT NULL
        THEN {_dec(_amount("l.imp_unitario"))} END) AS gross,
    sum(CASE WHEN (l.ind_facturable = 'S' OR b.ind_tippag IS NOT NULL) AND {REGIME} = 'GN'
        THEN {_dec(_amount(UNIT_TAX))} END) AS tax_gn,
    sum(CASE WHEN (l.ind_facturable = 'S' OR b.ind_tippag IS NOT NULL) AND {REGIME} = 'EN'
        THEN {_dec(_amount(UNIT_TAX))} END) AS tax_en,
    sum(CASE WHEN l.ind_facturable = 'S' THEN {_dec(_amount("l.imp_unitario"))} END) AS billed,
    sum(CASE WHEN l.ind_facturable = 'S'
        THEN {_dec(_amount(_round(UNIT_TAX, "b.decimales")))} END) AS billed_tax,
    sum(CASE WHEN l.ind_facturable = 'S'
        THEN {_dec(_amount(_round(UNIT_TAX, "b.decimales_eur")))} END) AS billed_tax_eur
FROM hdr b JOIN cost l ON {BOOKING_LINE} {TAX_JOIN}
WHERE {NORMAL} GROUP BY b.grec_seq_rec, b.seq_reserva, l.sdiv_cod_divisa, l.ind_tipo_registro,
    l.ind_facturable = 'S', CASE WHEN {REGIME} IN ('GN', 'EN') THEN {REGIME} END""",
    "recharge_line": f"""SELECT l.grec_seq_rec, l.rres_seq_reserva, l.rext_ord_extra,
    l.sdiv_cod_divisa, {_dec(_amount("l.imp_unitario"))} AS amount, l.imp_unitario,
    CASE WHEN {REGIME} IN ('GN', 'EN') THEN {REGIME} END AS regime
FROM cost l WHERE l.ind_tipo_registro = 'DR' AND l.ind_facturable = 'S'
    AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e.excl_seq_rec = l.grec_seq_rec
        AND e.excl_seq_reserva = l.rres_seq_reserva AND e.excl_ord_extra = l.rext_ord_extra)""",
    "component_line": f"""SELECT l.seq_rec, l.seq_reserva, l.component,
    coalesce({_dec(
        "CASE WHEN l.ind_tipo_regimen_fac = 'E' "
        "THEN l.imp_margen_canal * (1 - 1 / (1 + v.pct_impuesto / 100)) "
        "ELSE l.imp_venta * (1 - 1 / (1 + v.pct_impuesto / 100)) "
        "- (l.imp_venta - l.imp_margen_canal) * (1 - 1 / (1 + p.pct_impuesto / 100)) END"
    )}, 0) AS canal,
    coalesce({_dec(
        "CASE WHEN l.ind_tipo_regimen_con = 'E' "
        "THEN l.imp_margen_canco * (1 - 1 / (1 + v.pct_impuesto / 100)) "
        "ELSE (l.imp_coste + l.imp_margen_canco) * (1 - 1 / (1 + v.pct_impuesto / 100)) "
        "- l.imp_coste * (1 - 1 / (1 + p.pct_impuesto / 100)) END"
    )}, 0) AS canco
FROM components l {COMPONENT_TAX_JOIN.format(a="v")} {COMPONENT_TAX_JOIN.format(a="p")}
WHERE l.component <> 'extra' OR NOT EXISTS (SELECT 1 FROM excluded e
    WHERE e.excl_seq_rec = l.seq_rec AND e.excl_seq_reserva = l.seq_reserva
        AND e.excl_ord_extra = l.ord_extra)""",
}

_LINE_RATES = """hdr b LEFT JOIN {sub} s ON b.grec_seq_rec = s.rec AND b.seq_reserva = s.res
LEFT JOIN fx lb ON lb.f = s.ccy AND lb.t = b.gdiv_cod_divisa AND lb.moment = b.policy_date AND lb.p IS NOT DISTINCT FROM b.partner_ttoo AND lb.c IS NOT DISTINCT FROM b.rate_company
LEFT JOIN fx le ON le.f = s.ccy AND le.t = 'EUR' AND le.moment = b.fec_creacion AND le.p IS NOT DISTINCT FROM b.partner_ttoo AND le.c IS NOT DISTINCT FROM b.rate_company
LEFT JOIN fx be ON be.f = b.gdiv_cod_divisa AND be.t = 'EUR' AND be.moment = b.fec_creacion AND be.p IS NOT DISTINCT FROM b.partner_ttoo AND be.c IS NOT DISTINCT FROM b.rate_company"""

_TTV = "s.tipo NOT IN ('O', 'V', 'D', 'W', 'Y', 'IT')"
_TAX = "s.tipo NOT IN ('O', 'D', 'IT', 'BT')"
_COST = "s.tipo NOT IN ('R', 'DR', 'OV', 'OC', 'CA', 'IT', 'PF', 'LL')"
_SALE = {
    "TTV_booking_currency": _plain(_only(_TTV, "s.gross")),
    "TTV_EUR_currency": _priced_total(_only(_TTV, "s.gross"), "be.rate"),
    "tax_ttv": _plain(_only(_TAX, "s.tax_gn")),
    "tax_ttv_eur": _priced_total(_only(_TAX, "s.tax_gn"), "be.rate"),
    "tax_ttv_toms": _plain(_only(_TAX, "s.tax_en")),
    "Tax_TTV_EUR_TOMS": _priced_total(_only(_TAX, "s.tax_en"), "be.rate"),
    "Client_Commision": _plain(_only("s.tipo IN ('O', 'V')", "s.billed")),
    "Client_EUR_Commision": _priced_total(_only("s.tipo IN ('O', 'V')", "s.billed"), "be.rate"),
    "Tax_Client_commision": _plain(_only("s.tipo = 'O'", "s.billed_tax")),
    "Tax_Client_EUR_commision": _priced_total(_only("s.tipo = 'O'", "s.billed_tax"), "be.rate"),
    "client_rappel": _plain(_only("s.tipo = 'D'", "s.billed")),
    "Client_EUR_rappel": _priced_total(_only("s.tipo = 'D'", "s.billed"), "be.rate"),
    "tax_client_rappel": _plain(_only("s.tipo = 'D'", "s.billed_tax")),
    "tax_Client_EUR_rappel": _priced_total(_only("s.tipo = 'D'", "s.billed_tax"), "be.rate"),
}
_COSTS = {
    "cost_booking_currency": _priced(_only(f"{_COST} AND s.tipo <> 'SC'", "s.gross"), "lb.rate"),
    "cost_eur_currency": _priced(_only(f"{_COST} AND s.tipo <> 'SC'", "s.gross"), "le.rate"),
    "tax_cost": _priced(_only(_COST, "s.tax_gn"), "lb.rate"),
    "tax_cost_EUR": _priced(_only(_COST, "s.tax_gn"), "le.rate"),
    "tax_cost_TOMS": _priced(_only(_COST, "s.tax_en"), "lb.rate"),
    "tax_cost_EUR_TOMS": _priced(_only(_COST, "s.tax_en"), "le.rate"),
}
_HOTEL: dict[str, str] = {}
for _code, (_gross, _tax, _gross_eur, _tax_eur) in HOTEL_PAY.items():
    _is = f"s.tipo = '{_code}'"
    _HOTEL[_gross] = _priced(_only(_is, "s.billed"), "lb.rate")
    _HOTEL[_tax] = _priced(_only(_is, "s.billed_tax"), "lb.rate")
    _HOTEL[_gross_eur] = _priced(_only(_is, "s.billed"), "le.rate")
    _HOTEL[_tax_eur] = _priced(_only(_is, "s.billed_tax_eur"), "le.rate")


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{value} AS {name}" for name, value in columns.items())


CTES |= {
    "m_sale": f"SELECT b.grec_seq_rec, b.seq_reserva, {_select(_SALE)} "
    f"FROM {_LINE_RATES.format(sub='sale_sub')} GROUP BY b.grec_seq_rec, b.seq_reserva",
    "m_cost": f"SELECT b.grec_seq_rec, b.seq_reserva, {_select({**_COSTS, **_HOTEL})} "
    f"FROM {_LINE_RATES.format(sub='cost_sub')} GROUP BY b.grec_seq_rec, b.seq_reserva",
    "m_dr": f"""SELECT b.grec_seq_rec, b.seq_reserva,
    {_priced("s.amount", "lb.rate")} AS dr_cost, {_priced("s.amount", "le.rate")} AS dr_cost_EUR
FROM hdr b LEFT JOIN (
    SELECT grec_seq_rec AS rec, rres_seq_reserva AS res, sdiv_cod_divisa AS ccy, rext_ord_extra,
        sum(amount) AS amount FROM recharge_line
    GROUP BY grec_seq_rec, rres_seq_reserva, sdiv_cod_divisa, rext_ord_extra, regime) s
    ON b.grec_seq_rec = s.rec AND b.seq_reserva = s.res
LEFT JOIN fx lb ON lb.f = s.ccy AND lb.t = b.gdiv_cod_divisa AND lb.moment = b.fec_creacion AND lb.p IS NOT DISTINCT FROM b.partner_ttoo AND lb.c IS NOT DISTINCT FROM b.rate_company
LEFT JOIN fx le ON le.f = s.ccy AND le.t = 'EUR' AND le.moment = b.fec_creacion AND le.p IS NOT DISTINCT FROM b.partner_ttoo AND le.c IS NOT DISTINCT FROM b.rate_company
GROUP BY b.grec_seq_rec, b.seq_reserva""",
    "m_agent": f"""SELECT b.grec_seq_rec, b.seq_reserva,
    {_priced_total("s.agent", "pb.rate")} AS GSA_Commision,
    {_priced_total("s.agent", "pe.rate")} AS GSA_EUR_Commision,
    {_priced_total("s.agent_tax", "pb.rate")} AS Tax_GSA_Commision,
    {_priced_total("s.agent_tax", "pe.rate")} AS Tax_GSA_EUR_Commision
FROM hdr b LEFT JOIN (
    SELECT seq_rec AS rec, seq_reserva AS res, sum({_dec("imp_com_age")}) AS agent,
        sum({_dec("imp_comision_imp")}) AS agent_tax
    FROM commission GROUP BY seq_rec, seq_reserva) s
    ON b.grec_seq_rec = s.rec AND b.seq_reserva = s.res
LEFT JOIN fx pb ON pb.f = b.cod_divisa_p AND pb.t = b.gdiv_cod_divisa AND pb.moment = b.policy_date AND pb.p IS NOT DISTINCT FROM b.partner_ttoo AND pb.c IS NOT DISTINCT FROM b.rate_company
LEFT JOIN fx pe ON pe.f = b.cod_divisa_p AND pe.t = 'EUR' AND pe.moment = b.fec_creacion AND pe.p IS NOT DISTINCT FROM b.partner_ttoo AND pe.c IS NOT DISTINCT FROM b.rate_company
GROUP BY b.grec_seq_rec, b.seq_reserva""",
    "component_sub": """SELECT seq_rec AS rec, seq_reserva AS res, component,
    sum(canal) AS canal, sum(canco) AS canco
FROM component_line GROUP BY seq_rec, seq_reserva, component""",
    "m_tp": f"""SELECT grec_seq_rec, seq_reserva,
    CAST({_round("canal", "decimales")} AS DOUBLE) AS Tax_Sales_Transfer_pricing,
    CAST({_round("canal + canco_eur + dr", "decimales")} AS DOUBLE) AS Transfer_pricing,
    CAST({_round("canco + dr", "decimales")} AS DOUBLE) AS Tax_Cost_Transfer_pricing,
    CAST(canal_eur AS DOUBLE) AS Tax_Sales_Transfer_pricing_EUR,
    CAST(canal_eur + canco_eur + dr_eur AS DOUBLE) AS Tax_Transfer_pricing_EUR,
    CAST(canco_eur + dr_eur AS DOUBLE) AS Tax_Cost_Transfer_pricing_EUR
FROM (SELECT b.grec_seq_rec, b.seq_reserva, b.decimales,
        coalesce(s.canal, 0) AS canal, coalesce(s.canco, 0) AS canco,
        CASE WHEN s.canal <> 0 AND be.rate IS NULL THEN NULL
            ELSE coalesce({_dec("CAST(s.canal AS DOUBLE) * be.rate")}, 0) END AS canal_eur,
        CASE WHEN s.canco <> 0 AND be.rate IS NULL THEN NULL
            ELSE coalesce({_dec("CAST(s.canco AS DOUBLE) * be.rate")}, 0) END AS canco_eur,
        {_dec("d.dr_cost")} AS dr, {_dec("d.dr_cost_EUR")} AS dr_eur
    FROM hdr b
    LEFT JOIN (SELECT seq_rec AS rec, seq_reserva AS res, sum(canal) AS canal,
            sum(canco) AS canco FROM component_line GROUP BY seq_rec, seq_reserva) s
        ON b.grec_seq_rec = s.rec AND b.seq_reserva = s.res
    LEFT JOIN fx be ON be.f = b.gdiv_cod_divisa AND be.t = 'EUR' AND be.moment = b.fec_creacion AND be.p IS NOT DISTINCT FROM b.partner_ttoo AND be.c IS NOT DISTINCT FROM b.rate_company
    LEFT JOIN m_dr d ON b.grec_seq_rec = d.grec_seq_rec AND b.seq_reserva = d.seq_reserva) t""",
}

_DAY = "'%Y-%m-%d'"
_SECOND = "'%Y-%m-%d %H:%M:%S'"
_MICRO = "'%Y-%m-%d %H:%M:%S.%f'"
_WINDOW = "'1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 23:59:59'"


def _fmt(value: str, pattern: str = _SECOND) -> str:
    return f"strftime({value}, {pattern})"


def _text_or_empty(value: str, pattern: str) -> str:
    return f"coalesce(strftime({value}, {pattern}), '')"


CTES |= {
    "first_event": """SELECT seq_rec, seq_reserva, min(fec_creacion) AS first_booking_ts
FROM booking_information WHERE tipo_op = 'A' GROUP BY seq_rec, seq_reserva""",
    "application": """SELECT seq_rec, seq_reserva, aplicacion FROM (
    SELECT *, row_number() OVER (PARTITION BY seq_rec, seq_reserva
        ORDER BY fec_creacion, aplicacion) AS n
    FROM booking_information WHERE tipo_op = 'A') e WHERE n = 1""",
    "service_count": """SELECT grec_seq_rec, rres_seq_reserva, count(*) AS n FROM hotel_sale
WHERE fec_cancelacion IS NULL GROUP BY grec_seq_rec, rres_seq_reserva""",
    "hotel_place": """SELECT grec_seq_rec, rres_seq_reserva, place FROM (
    SELECT v.*, h.izge_cod_destino || '-' || d.nom_destino AS place,
        row_number() OVER (PARTITION BY v.grec_seq_rec, v.rres_seq_reserva
            ORDER BY v.ghor_seq_hotel) AS n
    FROM hotel_sale v JOIN hotel h ON v.ghor_seq_hotel = h.seq_hotel
    JOIN destination d ON h.izge_cod_destino = d.ides_cod_destino AND d.sidi_cod_idioma = 'ENG'
    ) r WHERE n = 1""",
    "contract_place": """SELECT seq_rec, seq_reserva, place FROM (
    SELECT o.*, c.cod_destino || '-' || d.nom_destino AS place,
        row_number() OVER (PARTITION BY o.seq_rec, o.seq_reserva
            ORDER BY o.nom_contrato, c.cod_destino || '-' || d.nom_destino) AS n
    FROM other o JOIN contract_other c ON o.seq_rec = c.seq_rec
        AND o.nom_contrato = c.nom_contrato AND o.ind_tipo_otro = c.ind_tipo_otro
        AND o.fec_desde BETWEEN c.fec_desde AND c.fec_hasta
    JOIN destination d ON c.cod_destino = d.ides_cod_destino AND d.sidi_cod_idioma = 'ENG'
    ) r WHERE n = 1""",
    "direct": f"""SELECT b.grec_seq_rec, b.seq_reserva, b.gdiv_cod_divisa,
    {_fmt("b.fec_creacion", _MICRO)} AS fec_creacion,
    rf.semp_cod_emp AS semp_cod_emp_rf,
    b.grec_seq_rec || '-' || b.seq_reserva AS interface_id,
    re.semp_cod_emp AS operative_company, re.sofi_cod_ofi AS operative_office,
    re.des_receptivo AS operative_office_desc, b.grec_seq_rec AS operative_incoming,
    b.seq_reserva AS booking_id, b.fint_cod_interface AS interface,
    rf.semp_cod_emp AS invoicing_company, rf.sofi_cod_ofi AS invoicing_office,
    CAST(rf.seq_rec AS DOUBLE) AS invoicing_incoming,
    {_fmt("b.fec_creacion", _DAY)} AS creation_date,
    {_fmt("b.fec_creacion", _MICRO)} AS creation_ts,
    {_text_or_empty("b.fec_modifica", _DAY)} AS modification_date,
    {_text_or_empty("b.fec_modifica", _SECOND)} AS modification_ts,
    {_text_or_empty("b.fec_cancelacion", _DAY)} AS cancellation_date,
    {_text_or_empty("b.fec_cancelacion", _SECOND)} AS cancellation_ts,
    CASE WHEN b.fec_cancelacion IS NULL THEN 'N' ELSE 'S' END AS cancelled_booking,
    {_fmt("greatest(b.fec_creacion, b.fec_modifica, b.fec_cancelacion)", _DAY)} AS status_date,
    {_fmt("b.fec_desde", _DAY)} AS booking_service_from,
    {_fmt("b.fec_hasta", _DAY)} AS booking_service_to,
    t.seq_ttoo AS client_code, t.nom_corto_ttoo AS customer_name,
    coalesce(b.cod_pais_cliente, t.gpai_cod_pais_mercado) AS source_market,
    p.cod_iso AS source_market_iso, replace(b.nom_general, ';', '') AS holder,
    b.ind_tipo_credito AS credit_type, b.nro_ad AS num_adults, b.nro_ni AS num_childrens,
    b.gdep_cod_depart AS department_code, b.rtre_cod_tipo_res AS booking_type,
    b.ind_facturable_res AS invoicing_booking, b.ind_facturable_adm AS invoicing_admin,
    coalesce(b.pct_comision, 0) AS client_commision_esp,
    coalesce(b.pct_rappel, 0) AS client_override_esp, b.ind_confirma AS confirmed_booking,
    CASE WHEN i.partner_ttoo IS NULL THEN 'N' ELSE 'S' END AS Partner_booking,
    coalesce(b.cod_divisa_p, '') AS Partner_booking_currency,
    coalesce(b.seq_ttoo_p, 0) AS Partner_code, coalesce(b.cod_suc_p, 0) AS Partner_brand,
    coalesce(b.seq_agencia_p, 0) AS Partner_agency_code,
    coalesce(b.seq_sucursal_p, 0) AS Partner_agency_brand,
    coalesce(b.seq_rec_expediente, 0) AS Booking_file_incoming,
    coalesce(b.seq_res_expediente, 0) AS booking_file_number,
    CASE WHEN b.ind_tippag IS NULL THEN 'Merchant' ELSE 'Pago en hotel' END
        AS Accomodation_model,
    b.gdiv_cod_divisa AS booking_currency
FROM booking b JOIN ttoo t ON b.gtto_seq_ttoo = t.seq_ttoo
JOIN country p ON coalesce(b.cod_pais_cliente, t.gpai_cod_pais_mercado) = p.cod_pais
LEFT JOIN receptive re ON b.grec_seq_rec = re.seq_rec
LEFT JOIN receptive rf ON b.seq_rec_hbeds = rf.seq_rec
LEFT JOIN interface i ON b.fint_cod_interface = i.cod_interface""",
}


def _resale(conditional: str) -> str:
    return (
        "CASE CASE r.ind_status WHEN 'RR' THEN 'R' WHEN 'CN' THEN 'RL' "
        f"WHEN '{conditional}' THEN CASE WHEN b.fec_cancelacion IS NULL THEN 'RS' ELSE 'C' END "
        "ELSE r.ind_status END WHEN 'RS' THEN 'Reventa' WHEN 'C' THEN 'Cancelada' "
        "WHEN 'RL' THEN 'Liberada' WHEN 'R' THEN 'Reventa' END"
    )


CTES |= {
    "resale_label": f"""SELECT b.grec_seq_rec, b.seq_reserva, {_resale("RL")} AS canrec_status,
    {_resale("RV")} AS canrec_status_rv
FROM booking b LEFT JOIN resale r ON b.grec_seq_rec = r.seq_rec AND b.seq_reserva = r.seq_reserva""",
    "place_code": """SELECT b.grec_seq_rec, b.seq_reserva,
    coalesce(h.place, c.place, 'NO_DESTINATION_CODE') AS Destination_code
FROM booking b
LEFT JOIN hotel_place h ON b.grec_seq_rec = h.grec_seq_rec AND b.seq_reserva = h.rres_seq_reserva
LEFT JOIN contract_place c ON b.grec_seq_rec = c.seq_rec AND b.seq_reserva = c.seq_reserva""",
    "attributes": f"""SELECT d.*, {_fmt("e.first_booking_ts", _MICRO)} AS first_booking_ts,
    z.Destination_code, a.aplicacion AS Application, r.canrec_status,
    coalesce(s.n, 0) AS NUMBER_ACTIVE_ACC_SERV
FROM direct d
JOIN place_code z ON d.grec_seq_rec = z.grec_seq_rec AND d.seq_reserva = z.seq_reserva
JOIN resale_label r ON d.grec_seq_rec = r.grec_seq_rec AND d.seq_reserva = r.seq_reserva
LEFT JOIN first_event e ON d.grec_seq_rec = e.seq_rec AND d.seq_reserva = e.seq_reserva
LEFT JOIN application a ON d.grec_seq_rec = a.seq_rec AND d.seq_reserva = a.seq_reserva
LEFT JOIN service_count s ON d.grec_seq_rec = s.grec_seq_rec
    AND d.seq_reserva = s.rres_seq_reserva""",
}

# --- stored measures: table -> column -> (output, euro output or None) ---
STORED = {
    "ttv": {"ttv": ("TTV_booking_currency", "TTV_EUR_currency")},
    "tax_ttv": {
        "tax_ttv": ("tax_ttv", "tax_ttv_eur"),
        "tax_ttv_toms": ("tax_ttv_toms", "Tax_TTV_EUR_TOMS"),
    },
    "client_com": {"cli_comm": ("Client_Commision", "Client_EUR_Commision")},
    "tax_client_com": {"tax_client_com": ("Tax_Client_commision", "Tax_Client_EUR_commision")},
    "client_rap": {"cli_rappel": ("client_rappel", "Client_EUR_rappel")},
    "tax_client_rap": {"tax_cli_rappel": ("tax_client_rappel", "tax_Client_EUR_rappel")},
    "cost": {"booking_cost": ("cost_eur_currency", None)},
    "tax_cost": {"tax_cost": ("tax_cost_EUR", None), "tax_cost_toms": ("tax_cost_EUR_TOMS", None)},
    "gsa_comm": {
        "gsa_comm": ("GSA_Commision", "GSA_EUR_Commision"),
        "tax_gsa_comm": ("Tax_GSA_Commision", "Tax_GSA_EUR_Commision"),
    },
}
for _table, _names in zip(HOTEL_PAY_TABLES, HOTEL_PAY.values(), strict=True):
    STORED[_table] = {"gross_eur": (_names[2], None), "tax_eur": (_names[3], None)}

_STORED_COLUMNS: dict[str, str] = {}
_STORED_JOINS = []
for _table, _columns in STORED.items():
    _STORED_JOINS.append(
        f"LEFT JOIN measure_{_table} m_{_table} ON b.grec_seq_rec = m_{_table}.grec_seq_rec "
        f"AND b.seq_reserva = m_{_table}.seq_reserva"
    )
    for _column, (_output, _euro) in _columns.items():
        _value = f"CAST(coalesce(m_{_table}.{_column}, 0) AS DECIMAL(28,6))"
        _STORED_COLUMNS[_output] = f"CAST({_value} AS DOUBLE)"
        if _euro:
            _priced_value = _dec(f"CAST({_value} AS DOUBLE) * coalesce(fx.rate, 0)")
            _STORED_COLUMNS[_euro] = f"CAST({_priced_value} AS DOUBLE)"
CTES["stored_measures"] = (
    f"SELECT b.grec_seq_rec, b.seq_reserva, b.gdiv_cod_divisa, {_select(_STORED_COLUMNS)} "
    "FROM booking b LEFT JOIN daily_rate fx ON CAST(b.fec_creacion AS DATE) = fx.date "
    f"AND b.gdiv_cod_divisa = fx.currency {' '.join(_STORED_JOINS)}"
)

_TRANSFER_PLACEHOLDERS = [
    "MISSING_CANCO_Tax_Sales_Transfer_pricing",
    "MISSING_CANCO_Tax_Sales_Transfer_pricing_EUR",
    "MISSING_CANCO_Transfer_pricing",
    "missing_canco_tax_transfer_pricing_eur",
    "MISSING_CANCO_Tax_Cost_Transfer_pricing",
    "MISSING_CANCO_Tax_Cost_Transfer_pricing_EUR",
]
_OTHER_PLACEHOLDERS = [
    "missing_cost_booking_currency",
    "MISSING_tax_cost",
    "MISSING_tax_cost_TOMS",
    *[f"MISSING_{name}" for names in HOTEL_PAY.values() for name in names[:2]],
]
_ZEROES = ", ".join(f"0 AS {name}" for name in _OTHER_PLACEHOLDERS)
_ALL_ZEROES = ", ".join(
    f"0 AS {name}" for name in [*_TRANSFER_PLACEHOLDERS, *_OTHER_PLACEHOLDERS]
)
_KEY = "grec_seq_rec, seq_reserva"
_SAME_BOOKING = "d.grec_seq_rec = {m}.grec_seq_rec AND d.seq_reserva = {m}.seq_reserva"


def _join(name: str) -> str:
    return f"JOIN {name} ON {_SAME_BOOKING.format(m=name)}"


def _without_key(name: str, *more: str) -> str:
    return f"{name}.* EXCLUDE ({', '.join(['grec_seq_rec', 'seq_reserva', *more])})"


def _spread_request() -> str:
    return """SELECT grec_seq_rec, seq_reserva, gdiv_cod_divisa, nro_ni, nro_ad, cod_divisa_p,
    ind_tipo_credito AS kind_type, 'EUR' AS e, fec_creacion AS moment,
    CASE nro_ni WHEN 0 THEN 'V' WHEN 1 THEN 'C' ELSE 'F' END AS kind FROM booking"""


CTES |= {
    "spread_found": f"""SELECT q.*, coalesce(CASE kind WHEN 'V' THEN h.pct_venta
        WHEN 'C' THEN h.pct_compra ELSE h.pct_fixing END, 0) AS pct_spread
FROM ({_spread_request()}) q ASOF LEFT JOIN spread h ON q.kind_type = h.tipo_cambio
    AND q.gdiv_cod_divisa = h.cod_div_origen AND q.e = h.cod_div_destino
    AND q.moment >= h.fec_aplicacion""",
    "convert_request": """SELECT s.*, CASE WHEN nro_ad = 1 THEN coalesce(cod_divisa_p, 'C9')
        ELSE 'EUR' END AS target_ccy, CAST(seq_reserva AS DOUBLE) * CAST(1.37 AS DOUBLE) AS amount
FROM spread_found s""",
    "triangle_request": """SELECT grec_seq_rec, seq_reserva, gdiv_cod_divisa AS f,
    coalesce(cod_divisa_p, 'C9') AS t, fec_desde AS moment, 'EUR' AS e FROM booking""",
}


def _triangle(requests: str) -> str:
    return f"""SELECT q.*, CASE WHEN q.f = q.t THEN 1.0 ELSE coalesce(d.rate,
    CASE WHEN q.f = 'EUR' THEN 1.0 ELSE a.rate END
    * CASE WHEN q.t = 'EUR' THEN 1.0 ELSE z.rate END) END AS rate
FROM {requests} q
ASOF LEFT JOIN any_rate d ON q.f = d.f AND q.t = d.t AND q.moment >= d.fec_desde
ASOF LEFT JOIN any_rate a ON q.f = a.f AND q.e = a.t AND q.moment >= a.fec_desde
ASOF LEFT JOIN any_rate z ON q.e = z.f AND q.t = z.t AND q.moment >= z.fec_desde"""


CTES["convert_rated"] = _triangle(
    "(SELECT *, gdiv_cod_divisa AS f, target_ccy AS t FROM convert_request)"
)

_COMPANY_TYPE = """(SELECT h.{column} FROM company_rate_type h
    WHERE h.semp_cod_emp = rf.semp_cod_emp AND h.fec_aplicacion >= b.fec_creacion
    ORDER BY h.fec_aplicacion LIMIT 1)"""

_PURPOSES = "['R', 'C', 'L', 'A', 'X']"
CTES |= {
    "chain_request": f"""SELECT b.grec_seq_rec, b.seq_reserva, i.partner_ttoo AS p,
    rf.semp_cod_emp AS c, {_PURPOSES}[CAST(b.seq_reserva % 5 AS INTEGER) + 1] AS purpose,
    CASE WHEN b.seq_reserva % 11 = 0 THEN b.ind_tipo_credito END AS direct,
    b.gdiv_cod_divisa AS f,
    CASE WHEN b.seq_reserva % 97 <> 0 THEN
        CASE WHEN b.nro_ad = 1 THEN coalesce(b.cod_divisa_p, 'C9') ELSE 'EUR' END END AS t,
    CASE WHEN b.seq_reserva % 89 <> 0 THEN b.fec_creacion END AS moment,
    ['V', 'C', 'F'][CAST(b.nro_ni AS INTEGER) + 1] AS kind,
    CAST(b.seq_reserva AS DOUBLE) * CAST(1.37 AS DOUBLE) AS amount
FROM booking b LEFT JOIN interface i ON b.fint_cod_interface = i.cod_interface
LEFT JOIN receptive rf ON b.seq_rec_hbeds = rf.seq_rec""",
    "chain_judged": """SELECT *, CASE WHEN f IS NULL THEN 'no source currency'
    WHEN t IS NULL THEN 'no target currency' WHEN f = t THEN NULL
    WHEN moment IS NULL THEN 'no date' WHEN p IS NOT NULL OR direct IS NOT NULL THEN NULL
    WHEN c IS NULL THEN 'no company'
    WHEN purpose NOT IN ('R', 'C', 'L', 'A') THEN 'unknown purpose' END AS reason
FROM chain_request""",
    "chain_valid": "SELECT * FROM chain_judged WHERE reason IS NULL",
    "chain_answer": _answers("chain_valid"),
    "chain_all": """SELECT *, NULL AS ty, NULL AS rate, NULL AS source FROM chain_judged
WHERE reason IS NOT NULL UNION ALL BY NAME SELECT * FROM chain_answer""",
    "chain_spread": """SELECT q.*, coalesce(CASE kind WHEN 'V' THEN h.pct_venta
    WHEN 'C' THEN h.pct_compra ELSE h.pct_fixing END, 0) AS pct
FROM chain_all q ASOF LEFT JOIN spread h ON q.ty = h.tipo_cambio AND q.f = h.cod_div_origen
    AND q.t = h.cod_div_destino AND q.moment >= h.fec_aplicacion""",
}
_SPREAD_AMOUNT = "CASE WHEN f = t THEN amount ELSE amount * rate * (1 + pct / 100) END"

QUERIES: dict[str, str] = {
    "scan_projected": """SELECT grec_seq_rec AS grec_seq_rec_s, rres_seq_reserva, imp_unitario,
    ind_tipo_registro FROM sale""",
    "scan_date_window": f"""SELECT {_KEY}, {_fmt("fec_creacion")} AS fec_creacion,
    {_fmt("fec_modifica")} AS fec_modifica FROM booking
WHERE fec_creacion BETWEEN TIMESTAMP {_WINDOW} AND fec_modifica BETWEEN TIMESTAMP {_WINDOW}
    AND seq_reserva > 0""",
    "filter_predicates": f"""SELECT ind_tipo_registro, count(*) AS n_lines,
    CAST(sum({_dec("imp_unitario")}) AS DOUBLE) AS unit_amount
FROM sale WHERE ind_contra_apunte = 'N' AND ind_facturable = 'S' AND ind_tipo_registro <> 'CH'
    AND ind_tipo_registro NOT IN ('O', 'V', 'D', 'W', 'Y', 'IT')
GROUP BY ind_tipo_registro""",
    "payment_mode_filter": f"""SELECT b.grec_seq_rec, b.seq_reserva, count(*) AS n_lines
FROM booking b JOIN sale l ON {BOOKING_LINE} WHERE {PAYABLE}
GROUP BY b.grec_seq_rec, b.seq_reserva""",
    "scalar_functions": f"""SELECT {_KEY},
    gdep_cod_depart || '/' || ind_tipo_credito AS f_concat,
    gdep_cod_depart || cod_divisa_p AS f_concat_null,
    replace(nom_general, ';', '') AS f_replace,
    regexp_replace(nom_general, ';', '_', 'g') AS f_regexp_replace,
    coalesce(pct_comision, 0) AS f_nvl,
    coalesce(cod_divisa_p, cod_pais_cliente, 'NONE') AS f_nvl3,
    CASE WHEN ind_tippag IS NULL THEN 'Merchant' WHEN ind_tippag = 'H' THEN 'Hotel' END AS f_decode,
    CASE rtre_cod_tipo_res WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END AS f_decode_default,
    CASE WHEN rtre_cod_tipo_res = 'F' THEN 1 WHEN rtre_cod_tipo_res = 'O' THEN 2 ELSE 3 END
        AS f_case,
    {_fmt("date_trunc('day', fec_creacion)")} AS f_trunc,
    {_fmt("fec_creacion")} AS f_to_char,
    strftime(strptime('01/03/2017', '%d/%m/%Y'), {_DAY}) AS f_to_date,
    {_fmt("greatest(fec_creacion, fec_modifica, fec_cancelacion)")} AS f_greatest,
    CAST(date_diff('day', CAST(fec_desde AS DATE), CAST(fec_hasta AS DATE)) AS INTEGER)
        AS f_datediff,
    CAST({_dec("CAST(pct_comision AS DOUBLE) / (nro_ni + 3) - 1")} AS DOUBLE) AS f_arithmetic,
    CAST(CAST(CAST(seq_reserva AS DOUBLE) / 7 AS DECIMAL(15,3)) AS DOUBLE) AS f_cast,
    'R' AS f_lit FROM booking""",
    "night_amount": f"""SELECT l.grec_seq_rec, l.rres_seq_reserva, l.nro_pax, l.nro_unidades,
    l.imp_unitario, CAST({_days()} AS DOUBLE) AS days,
    CAST({_dec(_amount("l.imp_unitario"))} AS DOUBLE) AS amount,
    CAST({_dec(_amount("l.imp_unitario",
        days=f"CASE WHEN l.nro_pax - 1 <> 0 THEN l.nro_pax - 1 ELSE {_days()} END"))} AS DOUBLE)
        AS amount_given_days FROM sale l""",
    "contained_tax": f"""SELECT l.rres_seq_reserva, l.imp_unitario, x.pct_impuesto,
    CAST({_dec(UNIT_TAX)} AS DOUBLE) AS unit_tax,
    CAST({_dec("1 - 1 / (1 + x.pct_impuesto / 100)")} AS DOUBLE) AS tax_share
FROM sale l {TAX_JOIN}""",
    "null_defaults": """SELECT b.grec_seq_rec, b.seq_reserva, coalesce(b.pct_comision, 0) AS pct_comision,
    coalesce(b.pct_rappel, 0) AS pct_rappel, coalesce(b.cod_divisa_p, '') AS cod_divisa_p,
    coalesce(s.n, 0) AS NUMBER_ACTIVE_ACC_SERV
FROM booking b LEFT JOIN service_count s
    ON b.grec_seq_rec = s.grec_seq_rec AND b.seq_reserva = s.rres_seq_reserva""",
    "dedupe_by_key": """SELECT grec_seq_rec, rres_seq_reserva, min(ghor_seq_hotel) AS ghor_seq_hotel
FROM hotel_sale GROUP BY grec_seq_rec, rres_seq_reserva""",
    "semi_join_keys": f"""SELECT l.grec_seq_rec, l.rres_seq_reserva, count(*) AS n_lines,
    CAST(sum({_dec("l.imp_unitario")}) AS DOUBLE) AS unit_amount
FROM sale l WHERE EXISTS (SELECT 1 FROM booking b WHERE {BOOKING_LINE}
    AND b.fec_creacion BETWEEN TIMESTAMP {_WINDOW})
GROUP BY l.grec_seq_rec, l.rres_seq_reserva""",
    "join_coalesced_key": f"SELECT {_KEY}, client_code, customer_name, source_market, "
    "source_market_iso FROM direct",
    "role_playing_dim": """SELECT b.grec_seq_rec, b.seq_reserva, re.semp_cod_emp AS operative_company,
    re.sofi_cod_ofi AS operative_office, re.des_receptivo AS operative_office_desc,
    rf.semp_cod_emp AS invoicing_company, rf.sofi_cod_ofi AS invoicing_office,
    CAST(rf.seq_rec AS DOUBLE) AS invoicing_incoming
FROM booking b LEFT JOIN receptive re ON b.grec_seq_rec = re.seq_rec
LEFT JOIN receptive rf ON b.seq_rec_hbeds = rf.seq_rec""",
    "validity_range_join": """SELECT o.seq_rec, o.seq_reserva, o.nom_contrato, o.ind_tipo_otro,
    c.cod_destino AS place
FROM other o JOIN contract_other c USING (seq_rec, nom_contrato, ind_tipo_otro)
WHERE o.fec_desde >= c.fec_desde AND o.fec_desde <= c.fec_hasta""",
    "validity_many_ranges": """SELECT o.seq_rec, o.seq_reserva, count(*) AS n_seasons,
    max(s.cod_season) AS last_season
FROM other o JOIN season s ON o.seq_rec = s.seq_rec
    AND o.fec_desde >= s.fec_desde AND o.fec_desde <= s.fec_hasta
GROUP BY o.seq_rec, o.seq_reserva""",
    "tax_lookup_outer": f"""SELECT l.rres_seq_reserva, l.nro_pax, l.rvp_cod_impuesto,
    l.rvp_cod_empresa, x.pct_impuesto FROM sale l {TAX_JOIN}""",
    "tax_lookup_inner": f"""SELECT l.seq_reserva, l.component, l.cod_impuesto_vta_fac,
    v.pct_impuesto AS pct_vta, p.pct_impuesto AS pct_cpa
FROM components l {COMPONENT_TAX_JOIN.format(a="v")} {COMPONENT_TAX_JOIN.format(a="p")}""",
    "campaign_exclusion": "SELECT * FROM excluded",
    "anti_join_not_in": f"""SELECT seq_rec, seq_reserva, count(*) AS n_lines,
    CAST(sum({_dec("imp_venta")}) AS DOUBLE) AS sale_amount
FROM canco_extra WHERE (seq_rec, seq_reserva, ord_extra) NOT IN (SELECT * FROM excluded)
GROUP BY seq_rec, seq_reserva""",
    "anti_join_not_exists": f"""SELECT grec_seq_rec, rres_seq_reserva, count(*) AS n_lines,
    CAST(sum({_dec("imp_unitario")}) AS DOUBLE) AS unit_amount
FROM recharge_line GROUP BY grec_seq_rec, rres_seq_reserva""",
    "direct_fields": "SELECT * FROM direct",
    "date_text_fields": f"""SELECT {_KEY}, {_fmt("fec_creacion", _DAY)} AS creation_date,
    {_fmt("fec_creacion")} AS creation_ts,
    {_text_or_empty("fec_modifica", _DAY)} AS modification_date,
    {_text_or_empty("fec_modifica", _SECOND)} AS modification_ts,
    {_text_or_empty("fec_cancelacion", _DAY)} AS cancellation_date,
    {_text_or_empty("fec_cancelacion", _SECOND)} AS cancellation_ts FROM booking""",
    "status_date": f"""SELECT {_KEY}, {_fmt('''greatest(CAST(fec_creacion AS DATE),
        coalesce(CAST(fec_modifica AS DATE), CAST(fec_creacion AS DATE)),
        coalesce(CAST(fec_cancelacion AS DATE), CAST(fec_modifica AS DATE),
            CAST(fec_creacion AS DATE)))''', _DAY)} AS status_date FROM booking""",
    "first_event_ts": f"""SELECT b.grec_seq_rec, b.seq_reserva, {_fmt("(SELECT min(i.fec_creacion) FROM booking_information i WHERE i.seq_rec = b.grec_seq_rec AND i.seq_reserva = b.seq_reserva AND i.tipo_op = 'A')", _MICRO)}
        AS first_booking_ts FROM booking b""",
    "first_application": "SELECT seq_rec AS grec_seq_rec, seq_reserva, aplicacion AS Application "
    "FROM application",
    "destination_code": "SELECT * FROM place_code",
    "resale_status": "SELECT * FROM resale_label",
    "active_services": """SELECT b.grec_seq_rec, b.seq_reserva, (SELECT count(*) FROM hotel_sale v
    WHERE v.grec_seq_rec = b.grec_seq_rec AND v.rres_seq_reserva = b.seq_reserva
        AND v.fec_cancelacion IS NULL) AS NUMBER_ACTIVE_ACC_SERV FROM booking b""",
    "fx_date_policy": f"SELECT {_KEY}, {_fmt('policy_date')} AS policy_date FROM hdr",
    "fx_daily_rate": f"""SELECT b.grec_seq_rec, b.seq_reserva, b.gdiv_cod_divisa,
    CAST({_dec("coalesce(r.rate, 0)")} AS DOUBLE) AS rate
FROM booking b LEFT JOIN daily_rate r ON CAST(b.fec_creacion AS DATE) = r.date
    AND b.gdiv_cod_divisa = r.currency""",
    "asof_rate": f"""SELECT q.grec_seq_rec, q.seq_reserva, CAST(q.partner_ttoo AS DOUBLE) AS partner_ttoo, q.gdiv_cod_divisa,
    CAST({_dec("CASE WHEN q.gdiv_cod_divisa = 'EUR' THEN 1 ELSE h.rate END")} AS DOUBLE) AS rate
FROM (SELECT b.*, i.partner_ttoo, 'EUR' AS e FROM booking b
    LEFT JOIN interface i ON b.fint_cod_interface = i.cod_interface) q
ASOF LEFT JOIN pair_rate h ON q.partner_ttoo = h.seq_ttoo AND q.gdiv_cod_divisa = h.f
    AND q.e = h.t AND q.fec_creacion >= h.fec_desde""",
    "asof_next_type": f"""SELECT b.grec_seq_rec, b.seq_reserva,
    coalesce({_COMPANY_TYPE.format(column="tipo_cambio_rex")}, 'ERROR') AS rate_type_r,
    coalesce({_COMPANY_TYPE.format(column="tipo_cambio_caj")}, 'ERROR') AS rate_type_c,
    coalesce({_COMPANY_TYPE.format(column="tipo_cambio_liq")}, 'ERROR') AS rate_type_l,
    coalesce({_COMPANY_TYPE.format(column="tipo_cambio_ctb")}, 'ERROR') AS rate_type_a
FROM booking b LEFT JOIN receptive rf ON b.seq_rec_hbeds = rf.seq_rec""",
    "asof_spread": f"SELECT {_KEY}, kind, CAST({_dec('pct_spread')} AS DOUBLE) AS pct_spread "
    "FROM spread_found",
    "fx_triangulate": f"SELECT {_KEY}, f AS gdiv_cod_divisa, t AS target_ccy, "
    f"CAST({_dec('rate')} AS DOUBLE) AS rate FROM ({_triangle('triangle_request')}) r",
    "fx_convert": f"""SELECT {_KEY}, gdiv_cod_divisa, target_ccy,
    {_round('''CASE WHEN f = t THEN amount
        ELSE amount * rate * (1 + CASE WHEN t = 'EUR' THEN pct_spread ELSE 0 END / 100) END''',
        "c.decimales")} AS exchanged
FROM convert_rated r LEFT JOIN currency c ON r.t = c.cod_divisa""",
    "fx_full_chain": f"""SELECT {_KEY}, f AS gdiv_cod_divisa, t AS target_ccy,
    CASE WHEN f = t OR rate IS NOT NULL THEN {_round(_SPREAD_AMOUNT, "c.decimales")} END AS exchanged,
    CASE WHEN f <> t THEN ty END AS exchanged_type, source AS exchanged_source,
    CAST({_dec("rate")} AS DOUBLE) AS exchanged_rate, reason AS exchanged_reason
FROM chain_spread r LEFT JOIN currency c ON r.t = c.cod_divisa""",
    "round_by_currency": f"""SELECT l.rres_seq_reserva, l.gdiv_cod_divisa,
    CAST({_dec("l.imp_unitario / 7")} AS DOUBLE) AS amount,
    {_round(_dec("l.imp_unitario / 7"), "c.decimales")} AS rounded
FROM sale l LEFT JOIN currency c ON l.gdiv_cod_divisa = c.cod_divisa""",
    "component_tax_sum": """SELECT seq_rec AS line_seq_rec, seq_reserva AS line_seq_reserva,
    CAST(sum(canal) AS DOUBLE) AS canal, CAST(sum(canco) AS DOUBLE) AS canco
FROM component_line GROUP BY seq_rec, seq_reserva""",
    "union_distinct_literal": "SELECT rec AS grec_seq_rec, res AS seq_reserva, "
    "CAST(sum(canal) AS DOUBLE) AS canal_distinct FROM ("
    + " UNION ".join(
        f"SELECT rec, res, canal FROM component_sub WHERE component = '{name}'"
        for name in ("hotel", "hotel_circuit", "other", "transfer", "endowments", "extra")
    )
    + ") u GROUP BY rec, res",
    "ttv": f"SELECT {_KEY}, TTV_booking_currency, TTV_EUR_currency FROM m_sale",
    "tax_ttv": f"SELECT {_KEY}, tax_ttv, tax_ttv_eur FROM m_sale",
    "tax_ttv_toms": f"SELECT {_KEY}, tax_ttv_toms, Tax_TTV_EUR_TOMS FROM m_sale",
    "client_commission": f"SELECT {_KEY}, Client_Commision, Client_EUR_Commision, "
    "Tax_Client_commision, Tax_Client_EUR_commision FROM m_sale",
    "client_rappel": f"SELECT {_KEY}, client_rappel, Client_EUR_rappel, tax_client_rappel, "
    "tax_Client_EUR_rappel FROM m_sale",
    "cost_measures": f"SELECT {_KEY}, {', '.join(_COSTS)} FROM m_cost",
    "gsa_commission": "SELECT * FROM m_agent",
    "hotel_pay_measures": f"SELECT {_KEY}, {', '.join(_HOTEL)} FROM m_cost",
    "dr_cost": "SELECT * FROM m_dr",
    "tax_sales_tp": f"SELECT {_KEY}, Tax_Sales_Transfer_pricing FROM m_tp",
    "transfer_pricing": f"SELECT {_KEY}, Transfer_pricing FROM m_tp",
    "tax_cost_tp": f"SELECT {_KEY}, Tax_Cost_Transfer_pricing FROM m_tp",
    "tp_eur_measures": f"SELECT {_KEY}, Tax_Sales_Transfer_pricing_EUR, "
    "Tax_Transfer_pricing_EUR, Tax_Cost_Transfer_pricing_EUR FROM m_tp",
    "measure_star_join": "SELECT * FROM stored_measures",
    "sql_star_extract": f"""SELECT d.*, {_without_key("stored_measures", "gdiv_cod_divisa")},
    {_ALL_ZEROES} FROM attributes d {_join("stored_measures")}""",
    "final_projection": "SELECT d.* EXCLUDE (gdiv_cod_divisa, fec_creacion, semp_cod_emp_rf), "
    f"{_ZEROES} FROM direct d",
    "stage_counts": """SELECT 'bookings' AS stage, count(*) AS n_rows FROM booking
UNION ALL SELECT 'market', count(*) FROM direct
UNION ALL SELECT 'first_event', count(*) FROM direct
UNION ALL SELECT 'active_services', count(*) FROM direct""",
    "full_extract": f"""SELECT d.* EXCLUDE (gdiv_cod_divisa, fec_creacion, semp_cod_emp_rf),
    {_without_key("m_sale")}, {_without_key("m_cost")}, {_without_key("m_agent")},
    {_without_key("m_tp")}
FROM attributes d {_join("m_sale")} {_join("m_cost")} {_join("m_agent")} {_join("m_tp")}""",
}
QUERIES["windowed_extract"] = f"""SELECT x.* FROM ({QUERIES["full_extract"]}) x
JOIN booking b ON x.operative_incoming = b.grec_seq_rec AND x.booking_id = b.seq_reserva
WHERE b.fec_creacion BETWEEN TIMESTAMP {_WINDOW} AND b.fec_modifica BETWEEN TIMESTAMP {_WINDOW}"""
QUERIES["rate_request_rejects"] = """SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n_requests
FROM chain_judged GROUP BY reason"""


def _unrated_rows(rows: str, ccy: str, columns: list[tuple[str, str, str, str]]) -> list[str]:
    return [
        f"""SELECT '{name}' AS measure, {ccy} AS currency,
    count(DISTINCT (b.grec_seq_rec, b.seq_reserva)) AS n_bookings, CAST(sum({amount}) AS DOUBLE) AS amount
FROM {rows} WHERE {condition} AND {amount} <> 0 AND {rate} IS NULL GROUP BY {ccy}"""
        for name, condition, amount, rate in columns
    ]


_SOLD = "s.tipo IN ('O', 'V')"
_HEADER_RATES = """LEFT JOIN fx be ON be.f = b.gdiv_cod_divisa AND be.t = 'EUR' AND be.moment = b.fec_creacion
    AND be.p IS NOT DISTINCT FROM b.partner_ttoo AND be.c IS NOT DISTINCT FROM b.rate_company
LEFT JOIN fx pb ON pb.f = b.cod_divisa_p AND pb.t = b.gdiv_cod_divisa AND pb.moment = b.policy_date
    AND pb.p IS NOT DISTINCT FROM b.partner_ttoo AND pb.c IS NOT DISTINCT FROM b.rate_company
LEFT JOIN fx pe ON pe.f = b.cod_divisa_p AND pe.t = 'EUR' AND pe.moment = b.fec_creacion
    AND pe.p IS NOT DISTINCT FROM b.partner_ttoo AND pe.c IS NOT DISTINCT FROM b.rate_company"""
_RECHARGED = """hdr b JOIN (
    SELECT grec_seq_rec AS rec, rres_seq_reserva AS res, sdiv_cod_divisa AS ccy, rext_ord_extra,
        sum(amount) AS amount FROM recharge_line
    GROUP BY grec_seq_rec, rres_seq_reserva, sdiv_cod_divisa, rext_ord_extra, regime) s
    ON b.grec_seq_rec = s.rec AND b.seq_reserva = s.res
LEFT JOIN fx lb ON lb.f = s.ccy AND lb.t = b.gdiv_cod_divisa AND lb.moment = b.fec_creacion
    AND lb.p IS NOT DISTINCT FROM b.partner_ttoo AND lb.c IS NOT DISTINCT FROM b.rate_company
LEFT JOIN fx le ON le.f = s.ccy AND le.t = 'EUR' AND le.moment = b.fec_creacion
    AND le.p IS NOT DISTINCT FROM b.partner_ttoo AND le.c IS NOT DISTINCT FROM b.rate_company"""
QUERIES["unrated_amounts"] = "\nUNION ALL\n".join(
    _unrated_rows(
        _LINE_RATES.format(sub="sale_sub"),
        "b.gdiv_cod_divisa",
        [
            ("TTV_EUR_currency", _TTV, "s.gross", "be.rate"),
            ("tax_ttv_eur", _TAX, "s.tax_gn", "be.rate"),
            ("Tax_TTV_EUR_TOMS", _TAX, "s.tax_en", "be.rate"),
            ("Client_EUR_Commision", _SOLD, "s.billed", "be.rate"),
            ("Tax_Client_EUR_commision", "s.tipo = 'O'", "s.billed_tax", "be.rate"),
            ("Client_EUR_rappel", "s.tipo = 'D'", "s.billed", "be.rate"),
            ("tax_Client_EUR_rappel", "s.tipo = 'D'", "s.billed_tax", "be.rate"),
        ],
    )
    + _unrated_rows(
        _LINE_RATES.format(sub="cost_sub"),
        "s.ccy",
        [
            ("cost_booking_currency", f"{_COST} AND s.tipo <> 'SC'", "s.gross", "lb.rate"),
            ("cost_eur_currency", f"{_COST} AND s.tipo <> 'SC'", "s.gross", "le.rate"),
            ("tax_cost", _COST, "s.tax_gn", "lb.rate"),
            ("tax_cost_EUR", _COST, "s.tax_gn", "le.rate"),
            ("tax_cost_TOMS", _COST, "s.tax_en", "lb.rate"),
            ("tax_cost_EUR_TOMS", _COST, "s.tax_en", "le.rate"),
            *[
                (name, f"s.tipo = '{code}'", amount, rate)
                for code, names in HOTEL_PAY.items()
                for name, amount, rate in zip(
                    names,
                    ("s.billed", "s.billed_tax", "s.billed", "s.billed_tax_eur"),
                    ("lb.rate", "lb.rate", "le.rate", "le.rate"),
                    strict=True,
                )
            ],
        ],
    )
    + _unrated_rows(_RECHARGED, "s.ccy", [("dr_cost", "true", "s.amount", "lb.rate"), ("dr_cost_EUR", "true", "s.amount", "le.rate")])
    + _unrated_rows(
        f"hdr b JOIN component_sub s ON b.grec_seq_rec = s.rec AND b.seq_reserva = s.res {_HEADER_RATES}",
        "b.gdiv_cod_divisa",
        [("canal_EUR", "true", "s.canal", "be.rate"), ("canco_EUR", "true", "s.canco", "be.rate")],
    )
    + _unrated_rows(
        f"""hdr b JOIN (SELECT seq_rec AS rec, seq_reserva AS res, sum({_dec("imp_com_age")}) AS agent,
    sum({_dec("imp_comision_imp")}) AS agent_tax FROM commission GROUP BY seq_rec, seq_reserva) s
    ON b.grec_seq_rec = s.rec AND b.seq_reserva = s.res {_HEADER_RATES}""",
        "b.cod_divisa_p",
        [
            ("GSA_Commision", "true", "s.agent", "pb.rate"),
            ("GSA_EUR_Commision", "true", "s.agent", "pe.rate"),
            ("Tax_GSA_Commision", "true", "s.agent_tax", "pb.rate"),
            ("Tax_GSA_EUR_Commision", "true", "s.agent_tax", "pe.rate"),
        ],
    )
)
QUERIES["clustered_hotel_pay"] = QUERIES["hotel_pay_measures"]
QUERIES["incremental_extract"] = f"""SELECT {_KEY}, TTV_booking_currency, TTV_EUR_currency,
    strftime(b.fec_creacion, '%Y') AS created FROM m_sale JOIN booking b USING (grec_seq_rec, seq_reserva)"""
_RECONCILED = {
    "ttv": ("ttv", "ttv", "TTV_booking_currency"),
    "tax_ttv": ("tax_ttv", "tax_ttv", "tax_ttv"),
    "tax_ttv_toms": ("tax_ttv", "tax_ttv_toms", "tax_ttv_toms"),
    "client_commission": ("client_com", "cli_comm", "Client_Commision"),
    "tax_client_commission": ("tax_client_com", "tax_client_com", "Tax_Client_commision"),
    "client_rappel": ("client_rap", "cli_rappel", "client_rappel"),
    "tax_client_rappel": ("tax_client_rap", "tax_cli_rappel", "tax_client_rappel"),
}
_HELD = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS measure, s.seq_reserva IS NULL AS extra, c.seq_reserva IS NULL AS missing,
    CAST(s.{old} AS DOUBLE) AS stored, CAST(c.{new} AS DOUBLE) AS computed
FROM measure_{table} s FULL JOIN m_sale c
    ON s.grec_seq_rec = c.grec_seq_rec AND s.seq_reserva = c.seq_reserva"""
    for name, (table, old, new) in _RECONCILED.items()
)
QUERIES["reconcile_measures"] = f"""SELECT measure, CASE WHEN missing THEN 'missing'
    WHEN extra THEN 'extra' WHEN stored IS NOT DISTINCT FROM computed THEN 'equal'
    WHEN abs(computed - stored) <= greatest(0.005, abs(stored) * CAST(0.01 AS DOUBLE)) THEN 'close'
    ELSE 'different' END AS verdict,
    count(*) AS n_bookings, max(abs(computed - stored)) AS largest
FROM ({_HELD}) held GROUP BY ALL"""
QUERIES["sink_roundtrip"] = QUERIES["date_text_fields"]


def _needed(text: str, found: dict[str, None]) -> None:
    """Collect the CTEs a text uses, each after the ones it depends on itself."""
    for name in dict.fromkeys(re.findall(r"\b\w+\b", text)):
        used = re.search(rf"\b(?:FROM|JOIN)\s+\(*{name}\b", text)
        if used and name in CTES and name not in found:
            _needed(CTES[name], found)
            found[name] = None


def oracle(name: str) -> str:
    found: dict[str, None] = {}
    _needed(QUERIES[name], found)
    ctes = ",\n".join(f"{cte} AS (\n{CTES[cte]}\n)" for cte in found)
    return f"WITH {ctes}\n{QUERIES[name]}" if ctes else QUERIES[name]


ORACLES = {name: oracle(name) for name in QUERIES}
