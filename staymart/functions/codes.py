"""Domain codes and output names."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: record-type codes, regimes, purposes and flags of the booking data ---
TTV_EXCLUDED = ["O", "V", "D", "W", "Y", "IT"]
SALE_TAX_EXCLUDED = ["O", "D", "IT"]
COMMISSION_TYPES = ["O", "V"]
OVERRIDE_TYPES = ["D"]
COST_EXCLUDED = ["R", "DR", "OV", "OC", "CA", "IT", "PF", "LL"]
RECHARGE_TYPE = "DR"
UNTAXED_SALE_TYPE = "BT"
UNTAXED_COMMISSION_TYPE = "V"
ZERO_COST_TYPE = "SC"
GENERAL_REGIME = "GN"
SPECIAL_REGIME = "EN"
EURO = "EUR"
NO_DESTINATION = "NO_DESTINATION_CODE"
DESTINATION_LANGUAGE = "ENG"
CREATION_EVENT = "A"
UNPROFITABLE_CAMPAIGN = "N"
RATE_PURPOSE_COLUMNS = {
    "R": "tipo_cambio_rex",
    "C": "tipo_cambio_caj",
    "L": "tipo_cambio_liq",
    "A": "tipo_cambio_ctb",
}
UNKNOWN_RATE_TYPE = "ERROR"
SPREAD_COLUMNS = {"V": "pct_venta", "C": "pct_compra", "F": "pct_fixing"}
COMPONENTS = ["hotel", "hotel_circuit", "other", "transfer", "endowments", "extra"]
CAMPAIGN_COMPONENT = "extra"
# --- end of fixed values ---


@dataclass(frozen=True)
class HotelPay:
    """Output names of one hotel-payment cost code."""

    code: str
    gross: str
    tax: str
    gross_eur: str
    tax_eur: str


# --- fixed values: hotel-payment codes and their output columns ---
HOTEL_PAY = [
    HotelPay(
        "CA",
        "Agency_commision_hotel_payment",
        "Tax_Agency_commision_hotel_pay",
        "agency_comm_hotel_pay_eur",
        "tax_agency_comm_hotel_pay_eur",
    ),
    HotelPay(
        "OC",
        "Fix_override_hotel_payment",
        "Tax_Fix_override_hotel_pay",
        "fix_override_hotel_pay_eur",
        "tax_fix_overr_hotel_pay_eur",
    ),
    HotelPay(
        "OV",
        "Var_override_hotel_payment",
        "Tax_Var_override_hotel_pay",
        "var_override_hotel_pay_eur",
        "Tax_Var_override_hotel_pay_EUR",
    ),
    HotelPay(
        "CH",
        "Hotel_commision_hotel_payment",
        "Tax_Hotel_commision_Hotel_pay",
        "hotel_commision_hotel_pay_eur",
        "tax_hotel_comm_hotel_pay_eur",
    ),
    HotelPay(
        "L",
        "Marketing_contribution",
        "Tax_marketing_contribution",
        "Marketing_contribution_EUR",
        "Tax_marketing_contribution_EUR",
    ),
    HotelPay(
        "K",
        "bank_expenses",
        "Tax_Bank_expenses",
        "bank_expenses_EUR",
        "Tax_Bank_expenses_EUR",
    ),
    HotelPay(
        "PF",
        "Platform_Fee",
        "Tax_Platform_fee",
        "Platform_Fee_EUR",
        "Tax_Platform_fee_EUR",
    ),
    HotelPay(
        "CT",
        "credit_card_fee",
        "Tax_credit_card_fee",
        "credit_card_fee_EUR",
        "Tax_credit_card_fee_EUR",
    ),
    HotelPay(
        "SC",
        "Withholding",
        "Tax_withholding",
        "Withholding_EUR",
        "Tax_withholding_EUR",
    ),
    HotelPay(
        "LL",
        "Local_Levy",
        "Tax_Local_Levy",
        "Local_Levy_EUR",
        "Tax_Local_Levy_EUR",
    ),
    HotelPay(
        "I",
        "Partner_Third_commision",
        "Tax_partner_third_commision",
        "partner_third_comm_eur",
        "tax_partner_third_comm_eur",
    ),
]
# --- end of fixed values ---

HOTEL_PAY_CODES = [item.code for item in HOTEL_PAY]
