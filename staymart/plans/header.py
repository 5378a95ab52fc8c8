"""Header part of the extract: one row of attributes per booking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymart.functions.attributes import (
    accommodation_model,
    day_text,
    holder,
    interface_id,
    null_flag,
    resale_status,
    second_text,
    status_date,
)
from staymart.functions.codes import CREATION_EVENT, DESTINATION_LANGUAGE, NO_DESTINATION
from staymart.operators.lookups import dimension_lookup, first_row, one_row
from staymart.operators.ranges import within_validity
from staymart.plans.measures import BOOKING_KEY


def with_market(booking: DataFrame, client: DataFrame, country: DataFrame) -> DataFrame:
    """Attach client and source market; bookings without either drop out.

    The market is the booking's country, or the client's when it has none.
    """
    sold = dimension_lookup(
        booking,
        client,
        "gtto_seq_ttoo",
        "seq_ttoo",
        {
            "seq_ttoo": "client_code",
            "nom_corto_ttoo": "customer_name",
            "gpai_cod_pais_mercado": "client_market",
        },
        "inner",
    )
    market = F.coalesce("cod_pais_cliente", "client_market")
    return dimension_lookup(
        sold.withColumn("source_market", market),
        country,
        "source_market",
        "cod_pais",
        {"cod_iso": "source_market_iso"},
        "inner",
    ).drop("client_market")


def with_offices(booking: DataFrame, receptive: DataFrame, how: str = "left") -> DataFrame:
    """The receptive office in its operative and its invoicing role."""
    operative = dimension_lookup(
        booking,
        receptive,
        "grec_seq_rec",
        "seq_rec",
        {
            "semp_cod_emp": "operative_company",
            "sofi_cod_ofi": "operative_office",
            "des_receptivo": "operative_office_desc",
        },
        how,
    )
    return dimension_lookup(
        operative,
        receptive,
        "seq_rec_hbeds",
        "seq_rec",
        {
            "semp_cod_emp": "invoicing_company",
            "sofi_cod_ofi": "invoicing_office",
            "seq_rec": "invoicing_incoming",
        },
        how,
    )


def direct_fields(
    booking: DataFrame,
    client: DataFrame,
    receptive: DataFrame,
    interface: DataFrame,
    country: DataFrame,
    how: str = "left",
) -> DataFrame:
    """Attributes that come straight from the booking and its dimensions."""
    rows = with_offices(with_market(booking, client, country), receptive, how)
    rows = dimension_lookup(
        rows,
        interface,
        "fint_cod_interface",
        "cod_interface",
        {"partner_ttoo": "partner_ttoo"},
        how,
    )
    created, modified = F.col("fec_creacion"), F.col("fec_modifica")
    cancelled = F.col("fec_cancelacion")

    def zero(name):
        return F.coalesce(F.col(name), F.lit(0))

    return rows.select(
        *BOOKING_KEY,
        "gdiv_cod_divisa",
        "fec_creacion",
        F.col("invoicing_company").alias("semp_cod_emp_rf"),
        interface_id(F.col("grec_seq_rec"), F.col("seq_reserva")).alias("interface_id"),
        "operative_company",
        "operative_office",
        "operative_office_desc",
        F.col("grec_seq_rec").alias("operative_incoming"),
        F.col("seq_reserva").alias("booking_id"),
        F.col("fint_cod_interface").alias("interface"),
        "invoicing_company",
        "invoicing_office",
        "invoicing_incoming",
        F.to_date(created).alias("creation_date"),
        created.alias("creation_ts"),
        day_text(modified).alias("modification_date"),
        second_text(modified).alias("modification_ts"),
        day_text(cancelled).alias("cancellation_date"),
        second_text(cancelled).alias("cancellation_ts"),
        null_flag(cancelled).alias("cancelled_booking"),
        status_date(created, modified, cancelled).alias("status_date"),
        F.to_date("fec_desde").alias("booking_service_from"),
        F.to_date("fec_hasta").alias("booking_service_to"),
        "client_code",
        "customer_name",
        "source_market",
        "source_market_iso",
        holder(F.col("nom_general")).alias("holder"),
        F.col("ind_tipo_credito").alias("credit_type"),
        F.col("nro_ad").alias("num_adults"),
        F.col("nro_ni").alias("num_childrens"),
        F.col("gdep_cod_depart").alias("department_code"),
        F.col("rtre_cod_tipo_res").alias("booking_type"),
        F.col("ind_facturable_res").alias("invoicing_booking"),
        F.col("ind_facturable_adm").alias("invoicing_admin"),
        zero("pct_comision").alias("client_commision_esp"),
        zero("pct_rappel").alias("client_override_esp"),
        F.col("ind_confirma").alias("confirmed_booking"),
        null_flag(F.col("partner_ttoo")).alias("Partner_booking"),
        F.coalesce("cod_divisa_p", F.lit("")).alias("Partner_booking_currency"),
        zero("seq_ttoo_p").alias("Partner_code"),
        zero("cod_suc_p").alias("Partner_brand"),
        zero("seq_agencia_p").alias("Partner_agency_code"),
        zero("seq_sucursal_p").alias("Partner_agency_brand"),
        zero("seq_rec_expediente").alias("Booking_file_incoming"),
        zero("seq_res_expediente").alias("booking_file_number"),
        accommodation_model(F.col("ind_tippag")).alias("Accomodation_model"),
        F.col("gdiv_cod_divisa").alias("booking_currency"),
    )


def first_event(information: DataFrame) -> DataFrame:
    """Earliest creation event per booking."""
    return (
        information.filter(F.col("tipo_op") == CREATION_EVENT)
        .groupBy(F.col("seq_rec").alias(BOOKING_KEY[0]), F.col("seq_reserva").alias(BOOKING_KEY[1]))
        .agg(F.min("fec_creacion").alias("first_booking_ts"))
    )


def first_application(information: DataFrame) -> DataFrame:
    """Application of the first creation event; ties settled by application code."""
    events = information.filter(F.col("tipo_op") == CREATION_EVENT).select(
        F.col("seq_rec").alias(BOOKING_KEY[0]),
        F.col("seq_reserva").alias(BOOKING_KEY[1]),
        "fec_creacion",
        F.col("aplicacion").alias("Application"),
    )
    return first_row(events, BOOKING_KEY, ["fec_creacion", "Application"]).drop("fec_creacion")


def creation_summary(information: DataFrame) -> DataFrame:
    """``first_event`` and ``first_application`` from one pass over the events."""
    return (
        information.filter(F.col("tipo_op") == CREATION_EVENT)
        .groupBy(F.col("seq_rec").alias(BOOKING_KEY[0]), F.col("seq_reserva").alias(BOOKING_KEY[1]))
        .agg(
            F.min("fec_creacion").alias("first_booking_ts"),
            F.min(F.struct("fec_creacion", "aplicacion"))["aplicacion"].alias("Application"),
        )
    )


def active_services(hotel_sale: DataFrame) -> DataFrame:
    """Hotel services per booking that are not cancelled."""
    return (
        hotel_sale.filter(F.col("fec_cancelacion").isNull())
        .groupBy(
            F.col("grec_seq_rec").alias(BOOKING_KEY[0]),
            F.col("rres_seq_reserva").alias(BOOKING_KEY[1]),
        )
        .agg(F.count(F.lit(1)).alias("NUMBER_ACTIVE_ACC_SERV"))
    )


def _named_places(destination: DataFrame) -> DataFrame:
    return destination.filter(F.col("sidi_cod_idioma") == DESTINATION_LANGUAGE)


def hotel_destination(
    hotel_sale: DataFrame, hotel: DataFrame, destination: DataFrame
) -> DataFrame:
    """Destination of the lowest-numbered hotel with a named destination.

    Hotels get their destination first, so service lines are joined once.
    """
    places = dimension_lookup(
        hotel, _named_places(destination), "izge_cod_destino", "ides_cod_destino",
        {"nom_destino": "label"}, "inner",
    ).withColumn("place", F.concat("izge_cod_destino", F.lit("-"), "label"))
    named = dimension_lookup(
        hotel_sale.select("grec_seq_rec", "rres_seq_reserva", "ghor_seq_hotel"),
        places,
        "ghor_seq_hotel",
        "seq_hotel",
        {"place": "hotel_destination"},
        "inner",
    ).select(
        F.col("grec_seq_rec").alias(BOOKING_KEY[0]),
        F.col("rres_seq_reserva").alias(BOOKING_KEY[1]),
        "ghor_seq_hotel",
        "hotel_destination",
    )
    order = ["ghor_seq_hotel", "hotel_destination"]
    return first_row(named, BOOKING_KEY, order).drop("ghor_seq_hotel")


def valid_contracts(other: DataFrame, contract_other: DataFrame) -> DataFrame:
    """Other services with the contracts valid on their service date."""
    return within_validity(
        other,
        contract_other,
        ["seq_rec", "nom_contrato", "ind_tipo_otro"],
        "fec_desde",
        "fec_desde",
        "fec_hasta",
        {"cod_destino": "place"},
    )


def contract_destination(
    other: DataFrame, contract_other: DataFrame, destination: DataFrame
) -> DataFrame:
    """Destination of the first contract, by name, valid on its service date."""
    named = dimension_lookup(
        valid_contracts(other, contract_other),
        _named_places(destination),
        "place",
        "ides_cod_destino",
        {"nom_destino": "label"},
        "inner",
    ).select(
        F.col("seq_rec").alias(BOOKING_KEY[0]),
        F.col("seq_reserva").alias(BOOKING_KEY[1]),
        "nom_contrato",
        F.concat("place", F.lit("-"), "label").alias("contract_destination"),
    )
    order = ["nom_contrato", "contract_destination"]
    return first_row(named, BOOKING_KEY, order).drop("nom_contrato")


def destination_code(
    booking: DataFrame,
    hotel_sale: DataFrame,
    hotel: DataFrame,
    destination: DataFrame,
    other: DataFrame,
    contract_other: DataFrame,
) -> DataFrame:
    """First hotel's destination, else first contract's, else a constant."""
    key = list(BOOKING_KEY)
    return (
        booking.select(*key)
        .join(hotel_destination(hotel_sale, hotel, destination), key, "left")
        .join(contract_destination(other, contract_other, destination), key, "left")
        .select(
            *key,
            F.coalesce(
                "hotel_destination", "contract_destination", F.lit(NO_DESTINATION)
            ).alias("Destination_code"),
        )
    )


def resale_labels(
    booking: DataFrame, resale: DataFrame, conditional_code: str = "RL"
) -> DataFrame:
    """Resale label per booking, null without a resale record."""
    record = one_row(
        resale.select(
            F.col("seq_rec").alias(BOOKING_KEY[0]),
            F.col("seq_reserva").alias(BOOKING_KEY[1]),
            "ind_status",
        ),
        BOOKING_KEY,
    )
    return (
        booking.select(*BOOKING_KEY, "fec_cancelacion")
        .join(record, list(BOOKING_KEY), "left")
        .select(
            *BOOKING_KEY,
            resale_status(F.col("ind_status"), F.col("fec_cancelacion"), conditional_code).alias(
                "canrec_status"
            ),
        )
    )
