"""Header attribute expressions: identifiers, flags, date texts, status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"


def interface_id(office: Column, booking: Column) -> Column:
    return F.concat(office.cast("string"), F.lit("-"), booking.cast("string"))


def day_text(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, DAY), F.lit(""))


def second_text(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, SECOND), F.lit(""))


def null_flag(value: Column, when_null: str = "N", otherwise: str = "S") -> Column:
    return F.when(value.isNull(), when_null).otherwise(otherwise)


def accommodation_model(payment_type: Column) -> Column:
    return null_flag(payment_type, "Merchant", "Pago en hotel")


def status_date(created: Column, modified: Column, cancelled: Column) -> Column:
    """Latest of the three days; greatest() skips nulls."""
    return F.greatest(F.to_date(created), F.to_date(modified), F.to_date(cancelled))


def holder(name: Column) -> Column:
    return F.replace(name, F.lit(";"), F.lit(""))


def resale_status(code: Column, cancelled: Column, conditional_code: str = "RL") -> Column:
    """Resale label; ``conditional_code`` is the code whose meaning depends on cancellation."""
    reduced = (
        F.when(code == "RR", "R")
        .when(code == "CN", "RL")
        .when(code == conditional_code, F.when(cancelled.isNull(), "RS").otherwise("C"))
        .otherwise(code)
    )
    return (
        F.when(reduced.isin("RS", "R"), "Reventa")
        .when(reduced == "C", "Cancelada")
        .when(reduced == "RL", "Liberada")
    )


def payable(payment_type: Column, billable: Column, record_type: Column) -> Column:
    """Sale line counts: billable for merchant bookings, anything but CH when paid at the hotel."""
    return (payment_type.isNull() & (billable == "S")) | (
        payment_type.isNotNull() & (record_type != "CH")
    )
