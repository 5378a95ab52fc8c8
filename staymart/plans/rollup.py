"""Reduction of booking lines before they meet their booking.

Lines are aggregated to one row per booking and line class (currency, record type, billable,
tax regime). What depends on the booking header - payment mode, exchange date, rounding scale -
is kept apart by class or as alternative sums and decided afterwards. Lines are dealt out by
booking once, as the few plain numbers that the sums need: a booking has few lines per class, so
sums taken before that would be as many as the lines, and wider. Everything after it - sums,
join to the header, measures - finds its rows in place. Lines of a table that is stored by
booking stay where they are. The tax percentage is looked up first, on the raw lines: they stay
where they are while the tax table is small enough to be broadcast, and are dealt out by salted
tax key otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymart.functions.amounts import (
    SCALES,
    UNIT,
    canal_tax,
    canco_tax,
    contained_tax,
    exact_sum_sql,
    micros,
    micros_sql,
    rounded_unit_sql,
    service_days,
    service_factor,
    service_quantity,
)
from staymart.functions.codes import (
    CAMPAIGN_COMPONENT,
    COMPONENTS,
    GENERAL_REGIME,
    RECHARGE_TYPE,
    SPECIAL_REGIME,
)
from staymart.operators.exclusion import EXCLUDED_KEY
from staymart.operators.lookups import COMPONENT_TAX_KEYS, exclude_whole_keys, tax_lookup

# Columns that tell the lines of one tax key apart.
LINE_SPREAD = ("grec_seq_rec", "rres_seq_reserva", "nro_pax")
COMPONENT_SPREAD = ("seq_rec", "seq_reserva", "imp_venta", "imp_coste")
ROLLUP_KEY = ("line_seq_rec", "line_seq_reserva")


def in_place(tables: Mapping[str, DataFrame], name: str) -> bool:
    """Whether a table of the working set is stored by booking."""
    return name in getattr(tables, "clustered", ())


def _regime(regime: Column, priced: Column) -> Column:
    """The two tax regimes that measures tell apart, null for any other."""
    known = [(whole, regime == whole[0], priced == whole[1:]) for whole in (GENERAL_REGIME, SPECIAL_REGIME)]
    first, *others = [(test & rest, whole) for whole, test, rest in known]
    found = F.when(*first)
    for test, whole in others:
        found = found.when(test, whole)
    return found


def rollup_lines(
    lines: DataFrame,
    tax: DataFrame,
    currency: str | None = None,
    explicit_tax: bool = False,
    exclusion: DataFrame | None = None,
    deal: bool = True,
) -> DataFrame:
    """Sums per (booking, currency, record type, billable, tax regime).

    Without ``currency`` lines are in the booking's.

    ``gross`` and ``tax`` are line amounts, ``unit_tax_<k>`` is tax whose unit amount was
    rounded to k places first. Counter-entries are left out, except among recharged
    costs. With ``exclusion`` set, recharged lines of excluded extras go. Columns nobody
    selects are pruned, and with them the tax lookup. Without ``deal`` lines are not dealt out
    by booking first, for those that lie so.
    """
    recharged = F.col("ind_tipo_registro") == RECHARGE_TYPE
    counted = lines.filter((F.col("ind_contra_apunte") == "N") | recharged)
    regime = _regime(F.col("ind_tipo_regimen"), F.coalesce("ind_trfprc", F.lit("N")))
    keys = {
        ROLLUP_KEY[0]: F.col("grec_seq_rec"),
        ROLLUP_KEY[1]: F.col("rres_seq_reserva"),
        **({"line_ccy": F.col(currency)} if currency else {}),
        "record_type": F.col("ind_tipo_registro"),
        "billable": F.coalesce(F.col("ind_facturable") == "S", F.lit(False)),
        "regime": regime,
    }
    extra = {} if exclusion is None else {"recharge_ord": F.when(recharged, F.col("rext_ord_extra"))}
    unit = F.col("imp_unitario").cast("double")
    rated = tax_lookup(counted, tax, spread_by=LINE_SPREAD).select(
        *[value.alias(name) for name, value in (keys | extra).items()],
        unit.alias("unit_amount"),
        F.col("pct_impuesto").cast("double").alias("tax_pct"),
        service_factor(
            F.col("fec_desde"),
            F.col("fec_hasta"),
            service_days(F.col("fec_desde"), F.col("fec_hasta"), F.col("ind_tipo_unid")),
            service_quantity(F.col("nro_unidades"), F.col("nro_pax"), F.col("ind_p_s")),
        )
        .cast("double")
        .alias("factor"),
        F.col("imp_impuesto" if explicit_tax else "imp_unitario").cast("double").alias("given_tax"),
    )
    if exclusion is not None:
        on = dict(zip((*ROLLUP_KEY, "recharge_ord"), EXCLUDED_KEY, strict=True))
        rated = exclude_whole_keys(rated, exclusion, on, "recharge_ord").drop("recharge_ord")
    if deal:
        rated = rated.repartition(*ROLLUP_KEY)
    # From the percentage only here: few values cross the network, and the scan has less to compile.
    taxed = rated.withColumn("unit_tax", contained_tax(F.col("unit_amount"), F.col("tax_pct")))
    priced = taxed.withColumns(
        {
            "tax_size": F.abs(F.rint(F.col("unit_tax") * UNIT)),
            "tax_factor": F.signum("unit_tax") * F.col("factor"),
        }
    )
    # The amounts are spelled out inside the sums, which Spark compiles one by one;
    # a projection of all of them would be too large a method to be optimised.
    line_tax = micros_sql("unit_tax * factor")
    amounts = {
        "gross": micros_sql("unit_amount * factor"),
        "tax": f"coalesce({micros_sql('given_tax')}, {line_tax})" if explicit_tax else line_tax,
        "unit_tax_raw": line_tax,
    }
    for scale in SCALES:
        rounded = rounded_unit_sql("tax_size", scale)
        amounts[f"unit_tax_{scale}"] = micros_sql(f"{rounded} * tax_factor")
    return priced.groupBy(*keys).agg(
        *[F.expr(f"{exact_sum_sql(amount)} AS {name}") for name, amount in amounts.items()]
    )


def union_components(tables: dict[str, DataFrame]) -> DataFrame:
    """The component tables as one, tagged with the component name."""
    merged = None
    for name in COMPONENTS:
        if name not in tables:
            continue
        tagged = tables[name].withColumn("component", F.lit(name))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return merged


def component_taxes(components: DataFrame, tax: DataFrame) -> DataFrame:
    """Channel and channel-company tax per line, in millionths.

    Sale and purchase percentage are two roles of one table under the same five
    key columns; lines without a tax row drop out.
    """
    rated = tax_lookup(
        components, tax, COMPONENT_TAX_KEYS, "pct_vta", "inner", spread_by=COMPONENT_SPREAD
    ).withColumn(
        "pct_cpa", F.col("pct_vta")
    )
    canal = canal_tax(
        F.col("ind_tipo_regimen_fac"),
        F.col("imp_margen_canal"),
        F.col("imp_venta"),
        F.col("pct_vta"),
        F.col("pct_cpa"),
    )
    canco = canco_tax(
        F.col("ind_tipo_regimen_con"),
        F.col("imp_margen_canco"),
        F.col("imp_coste"),
        F.col("pct_vta"),
        F.col("pct_cpa"),
    )
    return rated.withColumns(
        {
            "canal_micros": F.coalesce(micros(canal), F.lit(0)),
            "canco_micros": F.coalesce(micros(canco), F.lit(0)),
        }
    )


def rollup_components(
    components: DataFrame, tax: DataFrame, exclusion: DataFrame | None = None
) -> DataFrame:
    """Sums per (booking, component), without extras of excluded campaigns.

    Lines that have no extra number, or are not of the component that needs it, pass by the
    exclusion; all are dealt out by booking before they are summed.
    """
    campaign_extra = F.when(F.col("component") == CAMPAIGN_COMPONENT, F.col("ord_extra"))
    taxed = component_taxes(components, tax).select(
        F.col("seq_rec").alias(ROLLUP_KEY[0]),
        F.col("seq_reserva").alias(ROLLUP_KEY[1]),
        "component",
        *([] if exclusion is None else [campaign_extra.alias("component_ord")]),
        "canal_micros",
        "canco_micros",
    )
    if exclusion is not None:
        on = dict(zip((*ROLLUP_KEY, "component_ord"), EXCLUDED_KEY, strict=True))
        taxed = exclude_whole_keys(taxed, exclusion, on, "component_ord").drop("component_ord")
    return taxed.repartition(*ROLLUP_KEY).groupBy(*ROLLUP_KEY, "component").agg(
        F.expr(f"{exact_sum_sql('canal_micros')} AS canal"),
        F.expr(f"{exact_sum_sql('canco_micros')} AS canco"),
    )


def rollup_commissions(commission: DataFrame) -> DataFrame:
    """Agent commission and its tax per booking."""
    amounts = {
        "agent_micros": micros(F.col("imp_com_age")),
        "agent_tax_micros": micros(F.col("imp_comision_imp")),
    }
    return commission.withColumns(amounts).groupBy(
        F.col("seq_rec").alias(ROLLUP_KEY[0]), F.col("seq_reserva").alias(ROLLUP_KEY[1])
    ).agg(
        F.expr(f"{exact_sum_sql('agent_micros')} AS agent"),
        F.expr(f"{exact_sum_sql('agent_tax_micros')} AS agent_tax"),
    )
