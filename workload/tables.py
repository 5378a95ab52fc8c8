"""Booking tables derived from the driver tables.

Each table is one SQL text, so Spark and the oracle engine derive the same rows. The
few spellings that differ between the two engines are in ``Dialect``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
]


@dataclass(frozen=True)
class Dialect:
    days: Callable[[str, str], str]
    seconds: Callable[[str, str], str]
    quarters: str
    both: str
    pick: Callable[[str, list[str]], str]
    micros: Callable[[str], str]


def _codes(codes: list[str]) -> str:
    return ", ".join(f"'{code}'" for code in codes)


SPARK = Dialect(
    days=lambda ts, n: f"({ts} + make_dt_interval(CAST({n} AS INT)))",
    seconds=lambda ts, n: f"({ts} + make_dt_interval(0, 0, 0, CAST({n} AS INT)))",
    quarters=(
        "explode(sequence(TIMESTAMP_NTZ'1994-01-01', TIMESTAMP_NTZ'2002-10-01', "
        "INTERVAL '3' MONTH))"
    ),
    both="explode(array(0, 1))",
    pick=lambda n, codes: f"array({_codes(codes)})[CAST({n} AS INT)]",
    micros=lambda v: (
        f"CAST(rint(({v}) * 1000000) AS BIGINT) * CAST(0.000001 AS DECIMAL(7,6))"
    ),
)
DUCKDB = Dialect(
    days=lambda ts, n: f"({ts} + to_days(CAST({n} AS INTEGER)))",
    seconds=lambda ts, n: f"({ts} + to_seconds(CAST({n} AS INTEGER)))",
    quarters=(
        "unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2002-10-01', "
        "INTERVAL 3 MONTH))"
    ),
    both="unnest([0, 1])",
    pick=lambda n, codes: f"([{_codes(codes)}])[CAST({n} AS INTEGER) + 1]",
    micros=lambda v: (
        f"CAST(round_even(({v}) * 1000000, 0) AS BIGINT) "
        "* CAST(0.000001 AS DECIMAL(7,6))"
    ),
)


def _office(key: str) -> str:
    return f"(CAST(floor({key} / 8) AS BIGINT) % 25)"


def _currency(number: str) -> str:
    return f"CASE WHEN {number} = 0 THEN 'EUR' ELSE concat('C', {number}) END"


def _tax_keys(number: str, names: list[str]) -> str:
    parts = [
        f"CASE WHEN {number} % 2 = 0 THEN 'V' ELSE 'C' END",
        f"concat('I', {number})",
        f"concat('S', {number} % 3)",
        f"concat('L', {number} % 2)",
        f"concat('E', {number} % 5)",
    ]
    return ", ".join(f"{part} AS {name}" for part, name in zip(parts, names, strict=True))


SALE_CODES = ["H", "O", "V", "D", "W", "Y", "IT", "BT", "CH", "X"]
COST_CODES = [
    "CA", "OC", "OV", "CH", "L", "K", "PF", "CT", "SC", "LL", "I", "DR", "H", "R", "IT", "X",
]


def _line(d: Dialect, codes: list[str]) -> str:
    tax = _tax_keys(
        "l_partkey % 60",
        ["rvp_ind_tipo_imp", "rvp_cod_impuesto", "rvp_cod_esquema", "rvp_cod_clasif", "rvp_cod"],
    ).replace(
        "concat('E', l_partkey % 60 % 5) AS rvp_cod",
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('E', l_partkey % 60 % 5) END "
        "AS rvp_cod_empresa",
    )
    return f"""
    {_office("l_orderkey")} AS grec_seq_rec,
    l_orderkey AS rres_seq_reserva,
    l_shipdate AS fec_desde,
    CASE WHEN l_partkey % 50 = 0 THEN NULL
         ELSE {d.days("l_shipdate", "l_partkey % 14")} END AS fec_hasta,
    CAST(l_quantity AS INT) AS nro_unidades,
    l_linenumber AS nro_pax,
    CASE l_returnflag WHEN 'A' THEN 'N' WHEN 'N' THEN 'S' ELSE 'P' END AS ind_tipo_unid,
    CASE l_linestatus WHEN 'F' THEN 'P' ELSE 'S' END AS ind_p_s,
    l_extendedprice AS imp_unitario,
    {d.pick(f"l_partkey % {len(codes)}", codes)} AS ind_tipo_registro,
    CASE WHEN l_suppkey % 5 = 0 THEN 'N' ELSE 'S' END AS ind_facturable,
    CASE WHEN l_partkey % 17 = 0 THEN 'S' ELSE 'N' END AS ind_contra_apunte,
    CASE l_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'N' ELSE 'S' END AS ind_trfprc,
    CASE WHEN l_quantity < 25 THEN 'E' ELSE 'G' END AS ind_tipo_regimen,
    {tax}"""


_COMPONENT_NAMES = ["hotel", "hotel_circuit", "other", "transfer", "endowments", "extra"]


def _component() -> str:
    tax = _tax_keys(
        "l_partkey % 60",
        [
            "ind_tipo_imp_vta_fac",
            "cod_impuesto_vta_fac",
            "cod_esquema_vta_fac",
            "cod_clasif_vta_fac",
            "cod_empresa_vta_fac",
        ],
    )
    return f"""
    {_office("l_orderkey")} AS seq_rec,
    l_orderkey AS seq_reserva,
    CASE WHEN l_quantity < 25 THEN 'E' ELSE 'G' END AS ind_tipo_regimen_fac,
    CASE l_linestatus WHEN 'F' THEN 'E' ELSE 'G' END AS ind_tipo_regimen_con,
    l_extendedprice * l_discount AS imp_margen_canal,
    CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE l_extendedprice * 0.05 END AS imp_margen_canco,
    l_extendedprice AS imp_venta,
    l_extendedprice * 0.8 AS imp_coste,
    {tax},
    CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_linenumber AS BIGINT) END AS ord_extra"""


def definitions(d: Dialect) -> dict[str, str]:
    """Table name -> SELECT over the driver tables, each written as ``{table}``."""
    created = d.seconds("o_orderdate", "o_orderkey * 37 % 86400")
    # Years without end, two months, or few days; some end before they start.
    season = (
        "CASE WHEN o_orderkey % 256 = 0 THEN 2900000 WHEN o_orderkey % 8 = 1 THEN 60 ELSE o_custkey % 4 - 1 END"
    )
    service = d.days("o_orderdate", "o_custkey % 200")
    tables = {
        "booking": f"""SELECT
    {_office("o_orderkey")} AS grec_seq_rec,
    o_orderkey AS seq_reserva,
    concat('I', o_custkey % 27) AS fint_cod_interface,
    {created} AS fec_creacion,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL
         ELSE {d.days(created, "o_orderkey % 40")} END AS fec_modifica,
    CASE WHEN o_orderstatus = 'F'
         THEN {d.days(created, "o_orderkey % 60")} END AS fec_cancelacion,
    {service} AS fec_desde,
    {d.days(service, "o_orderkey % 15")} AS fec_hasta,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('P', o_custkey % 25) END
        AS cod_pais_cliente,
    concat('Holder;', o_custkey, ';', o_orderstatus) AS nom_general,
    CAST(1 + o_orderkey % 4 AS INT) AS nro_ad,
    CAST(o_orderkey % 3 AS INT) AS nro_ni,
    concat('D', o_custkey % 5) AS gdep_cod_depart,
    o_orderstatus AS rtre_cod_tipo_res,
    CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END AS ind_facturable_res,
    CASE WHEN o_custkey % 2 = 0 THEN 'S' ELSE 'N' END AS ind_facturable_adm,
    concat('T', o_custkey % 3) AS ind_tipo_credito,
    nullif(o_custkey % 20, 0) AS pct_comision,
    nullif(o_orderkey % 10, 0) AS pct_rappel,
    CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'S' END AS ind_confirma,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL
         ELSE {_currency("o_custkey % 25")} END AS cod_divisa_p,
    nullif(o_custkey % 7, 0) AS seq_ttoo_p,
    nullif(o_custkey % 4, 0) AS cod_suc_p,
    nullif(o_custkey % 11, 0) AS seq_agencia_p,
    nullif(o_custkey % 13, 0) AS seq_sucursal_p,
    nullif(o_orderkey % 5, 0) AS seq_rec_expediente,
    nullif(o_orderkey % 12, 0) AS seq_res_expediente,
    {_currency("o_orderkey % 26")} AS gdiv_cod_divisa,
    o_custkey AS gtto_seq_ttoo,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'H' END AS ind_tippag,
    o_orderkey % 30 AS seq_rec_hbeds
FROM {{orders}}""",
        "ttoo": """SELECT c_custkey AS seq_ttoo, c_name AS nom_corto_ttoo,
    concat('P', c_nationkey) AS gpai_cod_pais_mercado
FROM {customer}""",
        "receptive": """SELECT CAST(n_nationkey AS BIGINT) AS seq_rec,
    concat('E', n_regionkey) AS semp_cod_emp, concat('O', n_nationkey) AS sofi_cod_ofi,
    n_name AS des_receptivo
FROM {nation}""",
        "interface": """SELECT concat('I', n_nationkey) AS cod_interface,
    CAST(nullif(n_nationkey % 3, 0) AS BIGINT) AS partner_ttoo,
    CASE WHEN n_nationkey % 2 = 0 THEN 'E' ELSE 'C' END AS ind_fec_cam_div
FROM {nation}""",
        "country": """SELECT concat('P', n_nationkey) AS cod_pais,
    concat(substr(n_name, 1, 1), n_nationkey) AS cod_iso
FROM {nation}""",
        "booking_information": f"""SELECT {_office("user_id")} AS seq_rec,
    user_id AS seq_reserva, ts AS fec_creacion,
    CASE WHEN event_type = 'signup' THEN 'A' ELSE upper(substr(event_type, 1, 1)) END AS tipo_op,
    concat('APP', event_id % 5) AS aplicacion
FROM {{events}}""",
        "hotel": """SELECT p_partkey AS seq_hotel, concat('Z', p_size) AS izge_cod_destino
FROM {part}""",
        "hotel_sale": f"""SELECT {_office("l_orderkey")} AS grec_seq_rec,
    l_orderkey AS rres_seq_reserva, l_partkey AS ghor_seq_hotel,
    CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS fec_cancelacion
FROM {{lineitem}}""",
        "destination": """SELECT concat('Z', n_nationkey) AS ides_cod_destino,
    'ENG' AS sidi_cod_idioma, n_name AS nom_destino
FROM {nation}
UNION ALL
SELECT concat('Z', n_nationkey), 'ESP', concat('ES ', n_name) FROM {nation}""",
        "other": f"""SELECT {_office("o_orderkey")} AS seq_rec, o_orderkey AS seq_reserva,
    concat('CT', CAST(floor(o_orderkey / 4) AS BIGINT)) AS nom_contrato,
    concat('T', o_orderkey % 2) AS ind_tipo_otro,
    {service} AS fec_desde
FROM {{orders}}""",
        "contract_other": f"""SELECT {_office("o_orderkey")} AS seq_rec,
    concat('CT', CAST(floor(o_orderkey / 4) AS BIGINT)) AS nom_contrato,
    concat('T', o_orderkey % 2) AS ind_tipo_otro,
    concat('Z', o_custkey % 40) AS cod_destino,
    {d.days("o_orderdate", "o_custkey % 200 - o_orderkey % 30")} AS fec_desde,
    {d.days("o_orderdate", "o_custkey % 200 + 200 * (o_orderkey % 5)")} AS fec_hasta
FROM {{orders}}""",
        "season": f"""SELECT {_office("o_orderkey")} AS seq_rec,
    concat('S', o_custkey % 97) AS cod_season,
    {d.days("o_orderdate", "o_custkey % 200 - 30")} AS fec_desde,
    {d.days("o_orderdate", f"o_custkey % 200 - 30 + {season}")} AS fec_hasta
FROM {{orders}}""",
        "sale": f"""SELECT {_line(d, SALE_CODES)},
    CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice * l_tax END AS imp_impuesto,
    CASE WHEN l_linenumber = 6 THEN {_currency("(l_orderkey + 1) % 25")}
         ELSE {_currency("l_orderkey % 26")} END AS gdiv_cod_divisa
FROM {{lineitem}}""",
        "cost": f"""SELECT {_line(d, COST_CODES)},
    {_currency("l_suppkey % 26")} AS sdiv_cod_divisa,
    CASE WHEN l_linenumber <= 5 THEN CAST(l_linenumber AS BIGINT) END AS rext_ord_extra
FROM {{lineitem}}""",
        "commission": f"""SELECT {_office("l_orderkey")} AS seq_rec, l_orderkey AS seq_reserva,
    l_extendedprice * l_discount AS imp_com_age, l_extendedprice * l_tax AS imp_comision_imp
FROM {{lineitem}}""",
        "tax": f"""SELECT DISTINCT {_tax_keys(
            "p_size",
            ["ind_tipo_imp", "cod_impuesto", "cod_esquema", "cod_clasif", "cod_emp_atlas"],
        )},
    CAST(p_size % 22 AS DOUBLE) AS pct_impuesto
FROM {{part}}""",
        "components": f"""SELECT {_component()},
    {d.pick("l_suppkey % 6", _COMPONENT_NAMES)} AS component
FROM {{lineitem}}""",
        "extra": f"""SELECT {_office("l_orderkey")} AS grec_seq_rec,
    l_orderkey AS rres_seq_reserva, CAST(l_linenumber AS BIGINT) AS ord_extra,
    CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_partkey END AS num_bono,
    concat('I', l_suppkey % 3) AS cod_interface
FROM {{lineitem}}""",
        "discount_bond": """SELECT p_partkey AS num_bono, concat('I', p_partkey % 3) AS cod_interface,
    concat('K', p_size) AS cod_campana
FROM {part}""",
        "campaign": """SELECT DISTINCT concat('K', p_size) AS cod_campana,
    concat('I', p_partkey % 3) AS cod_interface,
    CASE WHEN p_size % 2 = 0 THEN 'N' ELSE 'S' END AS ind_rentabilidad
FROM {part}""",
        "resale": f"""SELECT {_office("o_orderkey")} AS seq_rec, o_orderkey AS seq_reserva,
    {d.pick("o_orderkey % 6", ["RR", "CN", "RL", "RV", "RS", "ZZ"])} AS ind_status
FROM {{orders}} WHERE o_orderpriority <> '5-LOW'""",
        "currency": f"""SELECT {_currency("n_nationkey")} AS cod_divisa,
    CASE WHEN n_nationkey = 0 THEN 2 ELSE n_nationkey % 4 END AS decimales
FROM {{nation}}""",
        "company_rate_type": f"""SELECT concat('E', r_regionkey) AS semp_cod_emp,
    {d.days("quarter", "r_regionkey")} AS fec_aplicacion,
    concat('T', (r_regionkey + month(quarter)) % 3) AS tipo_cambio_rex,
    concat('T', (r_regionkey + month(quarter) + 1) % 3) AS tipo_cambio_caj,
    concat('T', (r_regionkey + year(quarter)) % 3) AS tipo_cambio_liq,
    concat('T', (r_regionkey + year(quarter) + 1) % 3) AS tipo_cambio_ctb
FROM (SELECT r_regionkey, {d.quarters} AS quarter FROM {{region}}) q""",
        # Two partners with rates of their own; the second lacks every fourth currency.
        "partner_rate": f"""SELECT p AS seq_ttoo,
    CASE WHEN way = 0 THEN concat('C', k) ELSE 'EUR' END AS cod_divisa_ori,
    CASE WHEN way = 0 THEN 'EUR' ELSE concat('C', k) END AS cod_divisa_des,
    {d.days("quarter", "k % 20 + way * (k % 2) * 10 + p * 3")} AS fec_desde,
    0.5 + CAST(10 + 10 * ((k * 7 + month(quarter) + way + p * 5) % 13) AS DOUBLE) / 73 AS nro_tasa
FROM (SELECT k, quarter, way, CAST(1 + second AS BIGINT) AS p FROM (
    SELECT k, quarter, way, {d.both} AS second FROM (SELECT k, quarter, {d.both} AS way FROM (
        SELECT n_nationkey AS k, {d.quarters} AS quarter FROM {{nation}}) n) w) s) q
WHERE k > 0 AND (k % 3 > 0 OR way = 0) AND (k % 3 < 2 OR way = 1) AND (p = 1 OR k % 4 <> 1)""",
        # Rates of a rate type: most currencies against the euro, some pairs of others.
        "type_rate": f"""SELECT concat('T', ty) AS tipo_cambio,
    CASE WHEN k % 2 = 0 OR way = 1 THEN concat('C', k) ELSE 'EUR' END AS cod_div_origen,
    CASE WHEN way = 1 THEN concat('C', k % 24 + 1) WHEN k % 2 = 0 THEN 'EUR'
         ELSE concat('C', k) END AS cod_div_destino,
    {d.days("quarter", "k % 17 + ty * 2")} AS fec_aplicacion,
    0.5 + CAST(10 + 10 * ((k * 5 + month(quarter) + ty + way) % 11) AS DOUBLE) / 71 AS nro_tasa
FROM (SELECT k, quarter, way, 2 * high + low AS ty FROM (
    SELECT k, quarter, way, low, {d.both} AS high FROM (
        SELECT k, quarter, way, {d.both} AS low FROM (SELECT k, quarter, {d.both} AS way FROM (
            SELECT n_nationkey AS k, {d.quarters} AS quarter FROM {{nation}}) n) w) l) h) q
WHERE k > 0 AND ty < 3 AND CASE WHEN way = 0 THEN k % 5 <> 0 ELSE k % 6 = 0 END""",
        "spread": f"""SELECT concat('T', k % 3) AS tipo_cambio,
    concat('C', k) AS cod_div_origen, 'EUR' AS cod_div_destino,
    {d.days("quarter", "k % 20")} AS fec_aplicacion,
    CAST(k % 5 AS DOUBLE) / 2 AS pct_venta, CAST(k % 4 AS DOUBLE) / 4 AS pct_compra,
    CAST(month(quarter) % 3 AS DOUBLE) AS pct_fixing
FROM (SELECT n_nationkey AS k, {d.quarters} AS quarter FROM {{nation}}) q
WHERE k > 0""",
        "daily_rate": f"""SELECT CAST(o_orderdate AS DATE) AS date,
    {_currency("o_orderkey % 26")} AS currency,
    0.5 + CAST(10 + 10 * ((max(o_orderkey % 26) * 7 + day(CAST(o_orderdate AS DATE))) % 13) AS DOUBLE)
        / 73 AS rate
FROM {{orders}} WHERE o_orderkey % 26 <> 25
GROUP BY CAST(o_orderdate AS DATE), {_currency("o_orderkey % 26")}""",
    }
    for name in _COMPONENT_NAMES:
        tables[f"canco_{name}"] = (
            f"SELECT {_component()} FROM {{lineitem}} "
            f"WHERE l_suppkey % 6 = {_COMPONENT_NAMES.index(name)}"
        )
    stored = {
        "ttv": {"ttv": "l_extendedprice"},
        "tax_ttv": {"tax_ttv": "l_extendedprice * l_tax", "tax_ttv_toms": "l_tax * 100"},
        "client_com": {"cli_comm": "l_extendedprice * l_discount"},
        "tax_client_com": {"tax_client_com": "l_extendedprice * l_discount * l_tax"},
        "client_rap": {"cli_rappel": "l_discount * 100"},
        "tax_client_rap": {"tax_cli_rappel": "l_discount * l_tax * 100"},
        "cost": {"booking_cost": "l_extendedprice * 0.8"},
        "tax_cost": {"tax_cost": "l_extendedprice * 0.1", "tax_cost_toms": "l_quantity"},
        "gsa_comm": {"gsa_comm": "l_quantity * 0.5", "tax_gsa_comm": "l_quantity * l_tax"},
    }
    for number, name in enumerate(HOTEL_PAY_TABLES):
        code = COST_CODES[number]
        line_code = d.pick(f"l_partkey % {len(COST_CODES)}", COST_CODES)
        stored[name] = {
            "gross_eur": f"CASE WHEN {line_code} = '{code}' THEN l_extendedprice END",
            "tax_eur": f"CASE WHEN {line_code} = '{code}' THEN l_extendedprice * l_tax END",
        }
    for name, columns in stored.items():
        sums = ", ".join(
            f"sum({d.micros(value)}) AS {column}"
            for column, value in columns.items()
        )
        tables[f"measure_{name}"] = (
            f"SELECT {_office('l_orderkey')} AS grec_seq_rec, l_orderkey AS seq_reserva, {sums} "
            "FROM {lineitem} GROUP BY l_orderkey"
        )
    return tables


HOTEL_PAY_TABLES = [
    "age_comm_hot_pay",
    "fix_over_hot_pay",
    "var_over_hot_pay",
    "hot_comm_hot_pay",
    "marketing_contrib",
    "bank_exp",
    "platform_fee",
    "credit_card_fee",
    "withholding",
    "local_levy",
    "partner_third_comm",
]


class Tables(Mapping[str, DataFrame]):
    """Derived tables as lazy frames, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir
        self._definitions = definitions(SPARK)
        self._built: dict[str, DataFrame] = {}
        self._driver: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        if name not in self._driver:
            self._driver[name] = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._driver[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            text = self._definitions[name]
            used = {t: self.driver(t) for t in DRIVER_TABLES if f"{{{t}}}" in text}
            if name.startswith("measure_"):
                # Lines dealt out by order as they are: tables of the same columns share the exchange,
                # and none sums lines up before it, which hardly makes them fewer.
                used["lineitem"] = used["lineitem"].repartition("l_orderkey")
            self._built[name] = self.spark.sql(text, **used)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._definitions)

    def __len__(self) -> int:
        return len(self._definitions)


def oracle_definitions() -> dict[str, str]:
    """The same tables for the oracle engine."""
    names = {name: name for name in DRIVER_TABLES}
    return {name: text.format(**names) for name, text in definitions(DUCKDB).items()}
