"""Extras sold under campaigns that do not count towards profitability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymart.functions.codes import UNPROFITABLE_CAMPAIGN

EXCLUDED_KEY = ("excl_seq_rec", "excl_seq_reserva", "excl_ord_extra")


def campaign_exclusion(extra: DataFrame, bond: DataFrame, campaign: DataFrame) -> DataFrame:
    """Distinct (office, booking, extra) keys reached through bond and campaign."""
    campaigns = (
        campaign.filter(F.col("ind_rentabilidad") == UNPROFITABLE_CAMPAIGN)
        .select("cod_campana", "cod_interface")
        .distinct()
    )
    bonds = (
        bond.join(campaigns, ["cod_campana", "cod_interface"], "left_semi")
        .select("num_bono", "cod_interface")
    )
    return (
        extra.join(bonds, ["num_bono", "cod_interface"], "left_semi")
        .select(
            F.col("grec_seq_rec").alias(EXCLUDED_KEY[0]),
            F.col("rres_seq_reserva").alias(EXCLUDED_KEY[1]),
            F.col("ord_extra").alias(EXCLUDED_KEY[2]),
        )
        .na.drop()
        .distinct()
    )
