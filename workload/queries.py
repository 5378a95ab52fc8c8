"""Registered queries: each runs library plans over whole derived tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymart.functions import amounts, attributes
from staymart.functions.codes import COMPONENTS, TTV_EXCLUDED
from staymart.operators import exchange
from staymart.operators.full_exchange import (
    Asked,
    FullConverter,
    full_exchange,
    rate_sources,
    reject_counts,
    split_rejects,
)
from staymart.operators.exclusion import EXCLUDED_KEY, campaign_exclusion
from staymart.operators.lookups import (
    COMPONENT_TAX_KEYS,
    dimension_lookup,
    exclude_keys,
    exclude_keys_not_in,
    first_row,
    restrict_to_keys,
    tax_lookup,
)
from staymart.operators.ranges import within_validity
from staymart.plans import extract, header, measures, rollup, transfer
from staymart.plans.measure_tables import (
    MEASURE_TABLES,
    attach_measures,
    final_projection,
    side_by_side,
    with_placeholders,
)
from staymart.plans.star_sql import star_extract
from staymart.sources.catalog import changed_bookings, date_window, numbered, project
from staymart.plans.reconcile import reconcile, reconcile_summary
from staymart.sources.layout import Clustered, bucket_count, write_clustered
from staymart.sources.sinks import merge_extract, read_extract, shared_folder, write_extract
from workload.tables import Tables

CLUSTER_BUCKETS = 32
# By date of creation, modification or cancellation; together they hold every booking.
CHANGES = [
    ("0001-01-01 00:00:00", "1994-12-31 23:59:59"),
    ("1995-01-01 00:00:00", "1996-12-31 23:59:59"),
    ("1997-01-01 00:00:00", "9999-12-31 00:00:00"),
]
WINDOW = ("1996-01-01 00:00:00", "1998-12-31 23:59:59")
KEY = list(measures.BOOKING_KEY)


# Integer outputs that hold nulls; data frames on the comparing side show them as doubles.
NULLABLE_INTEGERS = ("days", "partner_ttoo", "invoicing_incoming")


def comparable(frame: DataFrame) -> DataFrame:
    """Decimals and nullable integers as doubles, so both engines report one type."""
    doubles = {
        field.name: F.col(field.name).cast("double")
        for field in frame.schema
        if isinstance(field.dataType, T.DecimalType) or field.name in NULLABLE_INTEGERS
    }
    return frame.withColumns(doubles) if doubles else frame


def _text(name: str) -> Column:
    return F.date_format(name, attributes.SECOND).alias(name)


def _exact(value: Column, name: str) -> Column:
    return amounts.from_micros(F.sum(amounts.micros(value))).alias(name)


def _converter(t: Mapping[str, DataFrame]) -> exchange.Converter:
    return FullConverter(rate_sources(t, spreads=False))


def _exclusion(t: Mapping[str, DataFrame]) -> DataFrame:
    return campaign_exclusion(t["extra"], t["discount_bond"], t["campaign"])


def _sale(t: Mapping[str, DataFrame]) -> DataFrame:
    return rollup.rollup_lines(t["sale"], t["tax"], explicit_tax=True, deal=not rollup.in_place(t, "sale"))


def _cost(t: Mapping[str, DataFrame]) -> DataFrame:
    return rollup.rollup_lines(t["cost"], t["tax"], "sdiv_cod_divisa", deal=not rollup.in_place(t, "cost"))


def _recharged_cost(t: Mapping[str, DataFrame]) -> DataFrame:
    return rollup.rollup_lines(t["cost"], t["tax"], "sdiv_cod_divisa", exclusion=_exclusion(t))


def _components(t: Mapping[str, DataFrame]) -> DataFrame:
    return rollup.rollup_components(t["components"], t["tax"], _exclusion(t))


# --- scans, filters, expressions ---


def scan_projected(t: Tables) -> DataFrame:
    return project(
        t["sale"],
        {
            "grec_seq_rec": "grec_seq_rec_s",
            "rres_seq_reserva": "rres_seq_reserva",
            "imp_unitario": "imp_unitario",
            "ind_tipo_registro": "ind_tipo_registro",
        },
    )


def scan_date_window(t: Tables) -> DataFrame:
    window = date_window(t["booking"], *WINDOW, on=("fec_modifica", "fec_creacion"))
    return numbered(window).select(*KEY, _text("fec_creacion"), _text("fec_modifica"))


def filter_predicates(t: Tables) -> DataFrame:
    return (
        t["sale"]
        .filter(
            (F.col("ind_contra_apunte") == "N")
            & (F.col("ind_facturable") == "S")
            & (F.col("ind_tipo_registro") != "CH")
            & ~F.col("ind_tipo_registro").isin(*TTV_EXCLUDED)
        )
        .groupBy("ind_tipo_registro")
        .agg(F.count(F.lit(1)).alias("n_lines"), _exact(F.col("imp_unitario"), "unit_amount"))
    )


def payment_mode_filter(t: Tables) -> DataFrame:
    lines = (
        t["sale"]
        .groupBy(
            F.col("grec_seq_rec").alias("line_seq_rec"),
            F.col("rres_seq_reserva").alias("line_seq_reserva"),
            "ind_facturable",
            "ind_tipo_registro",
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        t["booking"]
        .select(*KEY, "ind_tippag")
        .join(
            lines,
            (F.col("grec_seq_rec") == F.col("line_seq_rec"))
            & (F.col("seq_reserva") == F.col("line_seq_reserva")),
        )
        .filter(
            attributes.payable(
                F.col("ind_tippag"), F.col("ind_facturable"), F.col("ind_tipo_registro")
            )
        )
        .groupBy(*KEY)
        .agg(F.sum("n").alias("n_lines"))
    )


def night_amount(t: Tables) -> DataFrame:
    args = ["fec_desde", "fec_hasta", "nro_unidades", "nro_pax", "ind_tipo_unid", "ind_p_s"]
    args = [F.col(name) for name in [*args, "imp_unitario"]]
    return t["sale"].select(
        "grec_seq_rec",
        "rres_seq_reserva",
        "nro_pax",
        "nro_unidades",
        "imp_unitario",
        amounts.service_days(args[0], args[1], args[4]).cast("int").alias("days"),
        amounts.quantise(amounts.night_amount(*args)).alias("amount"),
        amounts.quantise(amounts.night_amount(*args, days=F.col("nro_pax") - 1)).alias(
            "amount_given_days"
        ),
    )


def contained_tax(t: Tables) -> DataFrame:
    return tax_lookup(t["sale"], t["tax"], spread_by=rollup.LINE_SPREAD).select(
        "rres_seq_reserva",
        "imp_unitario",
        "pct_impuesto",
        amounts.quantise(
            amounts.contained_tax(F.col("imp_unitario"), F.col("pct_impuesto"))
        ).alias("unit_tax"),
        amounts.quantise(amounts.tax_share(F.col("pct_impuesto"))).alias("tax_share"),
    )


def scalar_functions(t: Tables) -> DataFrame:
    pct, status = F.col("pct_comision"), F.col("rtre_cod_tipo_res")
    return t["booking"].select(
        *KEY,
        F.concat("gdep_cod_depart", F.lit("/"), "ind_tipo_credito").alias("f_concat"),
        F.concat("gdep_cod_depart", "cod_divisa_p").alias("f_concat_null"),
        F.replace("nom_general", F.lit(";"), F.lit("")).alias("f_replace"),
        F.regexp_replace("nom_general", ";", "_").alias("f_regexp_replace"),
        F.coalesce(pct, F.lit(0)).alias("f_nvl"),
        F.coalesce("cod_divisa_p", "cod_pais_cliente", F.lit("NONE")).alias("f_nvl3"),
        F.expr("decode(ind_tippag, NULL, 'Merchant', 'H', 'Hotel')").alias("f_decode"),
        F.expr("decode(rtre_cod_tipo_res, 'F', 'final', 'O', 'open')").alias("f_decode_default"),
        F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("f_case"),
        F.date_format(F.date_trunc("day", F.col("fec_creacion")), attributes.SECOND).alias(
            "f_trunc"
        ),
        F.date_format("fec_creacion", attributes.SECOND).alias("f_to_char"),
        F.date_format(F.to_date(F.lit("01/03/2017"), "dd/MM/yyyy"), attributes.DAY).alias(
            "f_to_date"
        ),
        F.date_format(
            F.greatest("fec_creacion", "fec_modifica", "fec_cancelacion"), attributes.SECOND
        ).alias("f_greatest"),
        F.datediff("fec_hasta", "fec_desde").alias("f_datediff"),
        amounts.quantise(pct.cast("double") / (F.col("nro_ni") + 3) - 1).alias("f_arithmetic"),
        (F.col("seq_reserva").cast("double") / 7).cast("decimal(15,3)").alias("f_cast"),
        F.lit("R").alias("f_lit"),
    )


def fx_date_policy(t: Tables) -> DataFrame:
    policy = measures.measure_header(
        t["booking"], t["interface"], t["currency"], measures.COST
    )
    return policy.select(*KEY, _text("policy_date"))


def null_defaults(t: Tables) -> DataFrame:
    return (
        t["booking"]
        .select(*KEY, "pct_comision", "pct_rappel", "cod_divisa_p")
        .join(header.active_services(t["hotel_sale"]), KEY, "left")
        .na.fill({"NUMBER_ACTIVE_ACC_SERV": 0, "pct_comision": 0, "pct_rappel": 0})
        .na.fill({"cod_divisa_p": ""})
    )


def dedupe_by_key(t: Tables) -> DataFrame:
    services = t["hotel_sale"].select("grec_seq_rec", "rres_seq_reserva", "ghor_seq_hotel")
    return first_row(
        services.dropDuplicates(), ["grec_seq_rec", "rres_seq_reserva"], ["ghor_seq_hotel"]
    )


# --- joins and lookups ---


def semi_join_keys(t: Tables) -> DataFrame:
    keys = date_window(t["booking"], *WINDOW)
    kept = restrict_to_keys(t["sale"], keys, extract.LINE_KEYS)
    return kept.groupBy("grec_seq_rec", "rres_seq_reserva").agg(
        F.count(F.lit(1)).alias("n_lines"), _exact(F.col("imp_unitario"), "unit_amount")
    )


def join_coalesced_key(t: Tables) -> DataFrame:
    return header.with_market(t["booking"], t["ttoo"], t["country"]).select(
        *KEY, "client_code", "customer_name", "source_market", "source_market_iso"
    )


def role_playing_dim(t: Tables) -> DataFrame:
    return header.with_offices(t["booking"], t["receptive"]).select(
        *KEY,
        "operative_company",
        "operative_office",
        "operative_office_desc",
        "invoicing_company",
        "invoicing_office",
        "invoicing_incoming",
    )


def validity_range_join(t: Tables) -> DataFrame:
    return header.valid_contracts(t["other"], t["contract_other"]).select(
        "seq_rec", "seq_reserva", "nom_contrato", "ind_tipo_otro", "place"
    )


def validity_many_ranges(t: Tables) -> DataFrame:
    """Seasons in force on the service date, of the thousands that an office has."""
    found = within_validity(
        t["other"],
        t["season"],
        ["seq_rec"],
        "fec_desde",
        "fec_desde",
        "fec_hasta",
        {"cod_season": "last_season"},
        count="n_seasons",
    )
    return (
        t["other"]
        .join(found, ["seq_rec", "fec_desde"])
        .groupBy("seq_rec", "seq_reserva")
        .agg(F.sum("n_seasons").alias("n_seasons"), F.max("last_season").alias("last_season"))
    )


def tax_lookup_outer(t: Tables) -> DataFrame:
    return tax_lookup(t["sale"], t["tax"], spread_by=rollup.LINE_SPREAD).select(
        "rres_seq_reserva", "nro_pax", "rvp_cod_impuesto", "rvp_cod_empresa", "pct_impuesto"
    )


def tax_lookup_inner(t: Tables) -> DataFrame:
    spread = rollup.COMPONENT_SPREAD
    sold = tax_lookup(t["components"], t["tax"], COMPONENT_TAX_KEYS, "pct_vta", "inner", spread)
    both = tax_lookup(sold, t["tax"], COMPONENT_TAX_KEYS, "pct_cpa", "inner", spread)
    return both.select("seq_reserva", "component", "cod_impuesto_vta_fac", "pct_vta", "pct_cpa")


def campaign_exclusion_set(t: Tables) -> DataFrame:
    return _exclusion(t)


def anti_join_not_in(t: Tables) -> DataFrame:
    on = dict(zip(["seq_rec", "seq_reserva", "ord_extra"], EXCLUDED_KEY, strict=True))
    return (
        exclude_keys_not_in(t["canco_extra"], _exclusion(t), on, "ord_extra")
        .groupBy("seq_rec", "seq_reserva")
        .agg(F.count(F.lit(1)).alias("n_lines"), _exact(F.col("imp_venta"), "sale_amount"))
    )


def anti_join_not_exists(t: Tables) -> DataFrame:
    on = dict(
        zip(["grec_seq_rec", "rres_seq_reserva", "rext_ord_extra"], EXCLUDED_KEY, strict=True)
    )
    lines = t["cost"].filter(
        (F.col("ind_tipo_registro") == "DR") & (F.col("ind_facturable") == "S")
    )
    return (
        exclude_keys(lines, _exclusion(t), on)
        .groupBy("grec_seq_rec", "rres_seq_reserva")
        .agg(F.count(F.lit(1)).alias("n_lines"), _exact(F.col("imp_unitario"), "unit_amount"))
    )


# --- header attributes ---


def direct_fields(t: Tables) -> DataFrame:
    rows = header.direct_fields(
        t["booking"], t["ttoo"], t["receptive"], t["interface"], t["country"]
    )
    return _dates_as_text(rows)


def _dates_as_text(rows: DataFrame) -> DataFrame:
    texts = {}
    for field in rows.schema:
        if isinstance(field.dataType, T.DateType):
            texts[field.name] = F.date_format(field.name, attributes.DAY)
        elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            texts[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.withColumns(texts)


def date_text_fields(t: Tables) -> DataFrame:
    return t["booking"].select(
        *KEY,
        attributes.day_text(F.col("fec_creacion")).alias("creation_date"),
        attributes.second_text(F.col("fec_creacion")).alias("creation_ts"),
        attributes.day_text(F.col("fec_modifica")).alias("modification_date"),
        attributes.second_text(F.col("fec_modifica")).alias("modification_ts"),
        attributes.day_text(F.col("fec_cancelacion")).alias("cancellation_date"),
        attributes.second_text(F.col("fec_cancelacion")).alias("cancellation_ts"),
    )


def status_date(t: Tables) -> DataFrame:
    status = attributes.status_date(
        F.col("fec_creacion"), F.col("fec_modifica"), F.col("fec_cancelacion")
    )
    return t["booking"].select(*KEY, F.date_format(status, attributes.DAY).alias("status_date"))


def first_event_ts(t: Tables) -> DataFrame:
    events = header.first_event(t["booking_information"])
    return _dates_as_text(t["booking"].select(*KEY).join(events, KEY, "left"))


def first_application(t: Tables) -> DataFrame:
    return header.first_application(t["booking_information"])


def destination_code(t: Tables) -> DataFrame:
    return header.destination_code(
        t["booking"],
        t["hotel_sale"],
        t["hotel"],
        t["destination"],
        t["other"],
        t["contract_other"],
    )


def resale_status(t: Tables) -> DataFrame:
    running = header.resale_labels(t["booking"], t["resale"])
    specified = header.resale_labels(t["booking"], t["resale"], "RV").withColumnRenamed(
        "canrec_status", "canrec_status_rv"
    )
    return running.join(specified, KEY)


def active_services(t: Tables) -> DataFrame:
    counted = header.active_services(t["hotel_sale"])
    return t["booking"].select(*KEY).join(counted, KEY, "left").na.fill(0)


# --- exchange ---


def _partnered(t: Tables) -> DataFrame:
    return dimension_lookup(
        t["booking"],
        t["interface"],
        "fint_cod_interface",
        "cod_interface",
        {"partner_ttoo": "partner_ttoo"},
    ).withColumn("euro", F.lit("EUR"))


def _six(name: str) -> Column:
    return amounts.quantise(F.col(name)).alias(name)


def fx_daily_rate(t: Tables) -> DataFrame:
    rated = exchange.daily_rate(
        t["booking"], t["daily_rate"], "gdiv_cod_divisa", "fec_creacion", "rate"
    )
    return rated.select(*KEY, "gdiv_cod_divisa", _six("rate"))


def asof_rate(t: Tables) -> DataFrame:
    rated = exchange.partner_rate(
        _partnered(t),
        exchange.rate_book(t["partner_rate"], by_partner=True),
        "partner_ttoo",
        "gdiv_cod_divisa",
        "euro",
        "fec_creacion",
        "rate",
    )
    return rated.select(*KEY, "partner_ttoo", "gdiv_cod_divisa", _six("rate"))


def asof_next_type(t: Tables) -> DataFrame:
    rows = header.with_offices(t["booking"], t["receptive"])
    rows = exchange.company_rate_types(
        rows,
        t["company_rate_type"],
        "invoicing_company",
        {f"rate_type_{purpose.lower()}": F.lit(purpose) for purpose in ("R", "C", "L", "A")},
        "fec_creacion",
    )
    return rows.select(*KEY, "rate_type_r", "rate_type_c", "rate_type_l", "rate_type_a")


def _spread_rows(t: Tables) -> DataFrame:
    return t["booking"].withColumns(
        {
            "euro": F.lit("EUR"),
            "rate_type": F.col("ind_tipo_credito"),
            "kind": F.element_at(
                F.array(F.lit("V"), F.lit("C"), F.lit("F")), F.col("nro_ni") + 1
            ),
        }
    )


def asof_spread(t: Tables) -> DataFrame:
    rated = exchange.spread_percent(
        _spread_rows(t),
        t["spread"],
        "rate_type",
        "gdiv_cod_divisa",
        "euro",
        "fec_creacion",
        "kind",
        "pct_spread",
    )
    return rated.select(*KEY, "kind", _six("pct_spread"))


def fx_triangulate(t: Tables) -> DataFrame:
    rows = t["booking"].withColumn("target_ccy", F.coalesce("cod_divisa_p", F.lit("C9")))
    rated = exchange.triangulated_rate(
        rows,
        exchange.rate_book(t["partner_rate"]),
        None,
        "gdiv_cod_divisa",
        "target_ccy",
        "fec_desde",
        "rate",
    )
    return rated.select(*KEY, "gdiv_cod_divisa", "target_ccy", _six("rate"))


def fx_convert(t: Tables) -> DataFrame:
    rows = _spread_rows(t).withColumns(
        {
            "amount": F.col("seq_reserva").cast("double") * 1.37,
            "target_ccy": F.when(F.col("nro_ad") == 1, F.coalesce("cod_divisa_p", F.lit("C9")))
            .otherwise(F.lit("EUR")),
        }
    )
    exchanged = exchange.currency_exchange(
        rows,
        t["partner_rate"],
        t["spread"],
        t["currency"],
        "amount",
        "gdiv_cod_divisa",
        "target_ccy",
        "fec_creacion",
        "rate_type",
        "kind",
        "exchanged",
    )
    return exchanged.select(*KEY, "gdiv_cod_divisa", "target_ccy", "exchanged")


def _chain_rows(t: Tables) -> DataFrame:
    """Bookings that ask for a rate in every way: by partner, company type or direct type."""
    rows = dimension_lookup(
        _partnered(t), t["receptive"], "seq_rec_hbeds", "seq_rec", {"semp_cod_emp": "rate_company"}
    )
    number = F.col("seq_reserva")
    purposes = F.array(*[F.lit(p) for p in ("R", "C", "L", "A", "X")])
    target = F.when(F.col("nro_ad") == 1, F.coalesce("cod_divisa_p", F.lit("C9"))).otherwise("EUR")
    return rows.withColumns(
        {
            "purpose": purposes[(number % 5).cast("int")],
            "direct": F.when(number % 11 == 0, F.col("ind_tipo_credito")),
            "target_ccy": F.when(number % 97 != 0, target),
            "kind": F.array(F.lit("V"), F.lit("C"), F.lit("F"))[F.col("nro_ni")],
            "amount": number.cast("double") * 1.37,
            "moment": F.when(number % 89 != 0, F.col("fec_creacion")),
        }
    )


CHAIN = Asked(
    "fx", "gdiv_cod_divisa", "target_ccy", "moment", "partner_ttoo", "rate_company", "purpose", "direct"
)


def fx_full_chain(t: Tables) -> DataFrame:
    columns = ["gdiv_cod_divisa", "target_ccy", "exchanged", "exchanged_type", "exchanged_source"]
    exchanged = full_exchange(
        _chain_rows(t), rate_sources(t), t["currency"], CHAIN, "amount", "kind", "exchanged"
    )
    return exchanged.select(*KEY, *columns, _six("exchanged_rate"), "exchanged_reason")


def rate_request_rejects(t: Tables) -> DataFrame:
    """Bookings that can't be asked for a rate, by reason, beside those that can."""
    rows = _chain_rows(t).select(*KEY, *CHAIN.columns())
    folder = f"{shared_folder(t.spark)}/rate-requests-{uuid4().hex}"
    good, rejects = split_rejects(rows, CHAIN, folder)
    accepted = good.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("n_requests"))
    return reject_counts(rejects).unionByName(accepted)


def round_by_currency(t: Tables) -> DataFrame:
    rows = t["sale"].withColumn("amount", amounts.quantise(F.col("imp_unitario") / 7))
    rounded = exchange.round_by_currency(
        rows, t["currency"], "amount", "gdiv_cod_divisa", "rounded"
    )
    return rounded.select("rres_seq_reserva", "gdiv_cod_divisa", "amount", "rounded")


# --- measures ---


def _fold(rows: Callable[[Tables], DataFrame], wanted: list) -> Callable[[Tables], DataFrame]:
    return lambda t: measures.booking_measures(t, rows(t), wanted, _converter(t))


def component_tax_sum(t: Tables) -> DataFrame:
    tables = {name: t[f"canco_{name}"] for name in COMPONENTS}
    united = rollup.union_components(tables)
    return (
        rollup.rollup_components(united, t["tax"], _exclusion(t))
        .groupBy(*rollup.ROLLUP_KEY)
        .agg(amounts.total(F.col("canal")).alias("canal"), amounts.total(F.col("canco")).alias("canco"))
    )


def union_distinct_literal(t: Tables) -> DataFrame:
    rows = _components(t)
    return transfer.distinct_subtotals(rows, "canal", "canal_distinct")


def unrated_amounts(t: Tables) -> DataFrame:
    """Of every measure that takes a rate, what it misses."""
    rollups = measures.stack_rollups(
        {
            "sale": _sale(t),
            "cost": _recharged_cost(t),
            "component": _components(t),
            "agent": rollup.rollup_commissions(t["commission"]),
        }
    )
    stacks = {
        "sale": measures.SALE,
        "cost": [*measures.COST, *measures.RECHARGE, *measures.HOTEL_PAYMENT],
        "component": measures.COMPONENT,
        "agent": measures.AGENT,
    }
    wanted = [m for source, those in stacks.items() for m in measures.of(source, those)]
    header_rows = measures.measure_header(
        t["booking"], t["interface"], t["currency"], wanted, receptive=t["receptive"]
    )
    return measures.unrated_amounts(header_rows, rollups, wanted, _converter(t))


def _transfer(*columns: str) -> Callable[[Tables], DataFrame]:
    def run(t: Tables) -> DataFrame:
        priced = transfer.transfer_pricing(
            t, _components(t), _recharged_cost(t), _converter(t)
        )
        return priced.select(*KEY, *columns)

    return run


# --- extracts ---


def _measures(t: Tables) -> dict[str, DataFrame]:
    return {name: t[f"measure_{name}"] for name in MEASURE_TABLES}


def measure_star_join(t: Tables) -> DataFrame:
    bookings = t["booking"].select(*KEY, "gdiv_cod_divisa", "fec_creacion")
    return attach_measures(bookings, _measures(t), t["daily_rate"]).drop("fec_creacion")


def sql_star_extract(t: Tables) -> DataFrame:
    return _dates_as_text(star_extract(t.spark, t, _measures(t)))


def final_projection_query(t: Tables) -> DataFrame:
    direct = header.direct_fields(
        t["booking"], t["ttoo"], t["receptive"], t["interface"], t["country"]
    )
    return _dates_as_text(final_projection(with_placeholders(direct)))


def sink_roundtrip(t: Tables) -> DataFrame:
    base = shared_folder(t.spark)
    rows = date_text_fields(t)
    write_extract(rows, base, "2017-03-26")
    return read_extract(t.spark, base, "2017-03-26")


def stage_counts(t: Tables) -> DataFrame:
    bookings = t["booking"].select(*KEY, "gtto_seq_ttoo", "cod_pais_cliente")
    events = header.first_event(t["booking_information"])
    services = header.active_services(t["hotel_sale"])
    return extract.stage_counts(
        bookings,
        [
            ("bookings", lambda rows: rows),
            ("market", lambda rows: header.with_market(rows, t["ttoo"], t["country"])),
            ("first_event", lambda rows: rows.join(events, KEY, "left")),
            ("active_services", lambda rows: rows.join(services, KEY, "left")),
        ],
    )


def full_extract(t: Tables) -> DataFrame:
    return _dates_as_text(extract.full_extract(t, _converter(t)))


def windowed_extract(t: Tables) -> DataFrame:
    window = date_window(t["booking"], *WINDOW, on=("fec_modifica", "fec_creacion"))
    return _dates_as_text(extract.windowed_extract(t, window, _converter(t)))


def clustered_hotel_pay(t: Tables) -> DataFrame:
    """The hotel-payment measures over a layout clustered by booking."""
    names = ["booking", "cost"]
    prefix = f"clustered_{uuid4().hex}"
    buckets = bucket_count(t, names, CLUSTER_BUCKETS)
    write_clustered(t, names, shared_folder(t.spark), prefix, buckets)
    return _fold(_cost, measures.HOTEL_PAYMENT)(Clustered(t.spark, prefix, names, t))


# Stored measure -> the computed one that it should equal.
RECONCILED = {
    "ttv": ("ttv", "ttv", "TTV_booking_currency"),
    "tax_ttv": ("tax_ttv", "tax_ttv", "tax_ttv"),
    "tax_ttv_toms": ("tax_ttv", "tax_ttv_toms", "tax_ttv_toms"),
    "client_commission": ("client_com", "cli_comm", "Client_Commision"),
    "tax_client_commission": ("tax_client_com", "tax_client_com", "Tax_Client_commision"),
    "client_rappel": ("client_rap", "cli_rappel", "client_rappel"),
    "tax_client_rappel": ("tax_client_rap", "tax_cli_rappel", "tax_client_rappel"),
}


def reconcile_measures(t: Tables) -> DataFrame:
    """Stored sale measures held against the computed ones, counted by verdict."""
    tables = list(dict.fromkeys(name for name, _, _ in RECONCILED.values()))
    stored = side_by_side({name: t[f"measure_{name}"] for name in tables}, tables)
    computed = _fold(_sale, measures.SALE)(t)
    pairs = {name: (f"{table}__{old}", new) for name, (table, old, new) in RECONCILED.items()}
    rows = reconcile(stored, computed, KEY, pairs, absolute=0.005, relative=0.01)
    return reconcile_summary(rows)


def incremental_extract(t: Tables) -> DataFrame:
    """An extract kept up to date over three windows of changes, the last one run twice."""
    folder = f"{shared_folder(t.spark)}/incremental"
    # Rates are not cut down to a window: one preparation serves all.
    convert = _converter(t)
    for window in (*CHANGES, CHANGES[-1]):
        changed = changed_bookings(t["booking"], *window)
        cut = extract.restrict_tables(t, changed)
        rows = measures.booking_measures(cut, _sale(cut), measures.TTV, convert)
        created = changed.select(*KEY, F.date_format("fec_creacion", "yyyy").alias("created"))
        merge_extract(rows.join(created, KEY), folder, KEY, "created")
    return t.spark.read.parquet(folder).withColumn("created", F.col("created").cast("string"))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "scan_projected": scan_projected,
    "scan_date_window": scan_date_window,
    "filter_predicates": filter_predicates,
    "payment_mode_filter": payment_mode_filter,
    "scalar_functions": scalar_functions,
    "night_amount": night_amount,
    "contained_tax": contained_tax,
    "null_defaults": null_defaults,
    "dedupe_by_key": dedupe_by_key,
    "semi_join_keys": semi_join_keys,
    "join_coalesced_key": join_coalesced_key,
    "role_playing_dim": role_playing_dim,
    "validity_range_join": validity_range_join,
    "validity_many_ranges": validity_many_ranges,
    "tax_lookup_outer": tax_lookup_outer,
    "tax_lookup_inner": tax_lookup_inner,
    "campaign_exclusion": campaign_exclusion_set,
    "anti_join_not_in": anti_join_not_in,
    "anti_join_not_exists": anti_join_not_exists,
    "direct_fields": direct_fields,
    "date_text_fields": date_text_fields,
    "status_date": status_date,
    "first_event_ts": first_event_ts,
    "first_application": first_application,
    "destination_code": destination_code,
    "resale_status": resale_status,
    "active_services": active_services,
    "fx_date_policy": fx_date_policy,
    "fx_daily_rate": fx_daily_rate,
    "asof_rate": asof_rate,
    "asof_next_type": asof_next_type,
    "asof_spread": asof_spread,
    "fx_triangulate": fx_triangulate,
    "fx_convert": fx_convert,
    "fx_full_chain": fx_full_chain,
    "rate_request_rejects": rate_request_rejects,
    "round_by_currency": round_by_currency,
    "ttv": _fold(_sale, measures.TTV),
    "tax_ttv": _fold(_sale, measures.TAX_TTV),
    "tax_ttv_toms": _fold(_sale, measures.TAX_TTV_TOMS),
    "client_commission": _fold(_sale, measures.CLIENT_COMMISSION),
    "client_rappel": _fold(_sale, measures.CLIENT_RAPPEL),
    "cost_measures": _fold(_cost, measures.COST),
    "unrated_amounts": unrated_amounts,
    "gsa_commission": _fold(
        lambda t: rollup.rollup_commissions(t["commission"]), measures.AGENT
    ),
    "hotel_pay_measures": _fold(_cost, measures.HOTEL_PAYMENT),
    "dr_cost": _fold(_recharged_cost, measures.RECHARGE),
    "component_tax_sum": component_tax_sum,
    "union_distinct_literal": union_distinct_literal,
    "tax_sales_tp": _transfer("Tax_Sales_Transfer_pricing"),
    "transfer_pricing": _transfer("Transfer_pricing"),
    "tax_cost_tp": _transfer("Tax_Cost_Transfer_pricing"),
    "tp_eur_measures": _transfer(
        "Tax_Sales_Transfer_pricing_EUR",
        "Tax_Transfer_pricing_EUR",
        "Tax_Cost_Transfer_pricing_EUR",
    ),
    "measure_star_join": measure_star_join,
    "sql_star_extract": sql_star_extract,
    "final_projection": final_projection_query,
    "sink_roundtrip": sink_roundtrip,
    "stage_counts": stage_counts,
    "full_extract": full_extract,
    "windowed_extract": windowed_extract,
    "clustered_hotel_pay": clustered_hotel_pay,
    "reconcile_measures": reconcile_measures,
    "incremental_extract": incremental_extract,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(QUERIES[name](Tables(spark, sf_dir)))
