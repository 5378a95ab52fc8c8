"""Currency exchange as lookups: rate histories, triangulation, spread, rounding.

A *converter* is a function ``(df, from_ccy, to_ccy, at, out) -> df`` that adds the
rate ``out``; ``to_ccy`` None stands for the euro. The plans take a converter as an
argument and stay free of rate sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymart.functions.amounts import round_to_scale
from staymart.functions.codes import (
    EURO,
    RATE_PURPOSE_COLUMNS,
    SPREAD_COLUMNS,
    UNKNOWN_RATE_TYPE,
)
from staymart.operators.asof import FORWARD, Intervals, asof_lookup, intervals

Converter = Callable[[DataFrame, str, str | None, str, str], DataFrame]


def pair_history(rates: DataFrame) -> DataFrame:
    """Every stored pair in both directions; ``preference`` ranks the stored one higher."""
    rate = F.col("nro_tasa").cast("double")
    stored = F.struct(
        F.col("cod_divisa_ori").alias("from_ccy"),
        F.col("cod_divisa_des").alias("to_ccy"),
        rate.alias("rate"),
        F.lit(2).alias("preference"),
    )
    inverse = F.struct(
        F.col("cod_divisa_des").alias("from_ccy"),
        F.col("cod_divisa_ori").alias("to_ccy"),
        (F.lit(1.0) / F.nullif(rate, F.lit(0.0))).alias("rate"),
        F.lit(1).alias("preference"),
    )
    return rates.select("seq_ttoo", "fec_desde", F.inline(F.array(stored, inverse)))


def rate_book(rates: DataFrame, by_partner: bool = False) -> Intervals:
    """Rates prepared for lookups; of two rates with one date the stored pair wins."""
    keys = ["from_ccy", "to_ccy"]
    if by_partner:
        keys = ["seq_ttoo", *keys]
    return intervals(
        pair_history(rates), keys, "fec_desde", tie_break=["preference", "rate"]
    )


def partner_rate(
    rows: DataFrame,
    book: Intervals,
    partner: str | None,
    from_ccy: str,
    to_ccy: str,
    at: str,
    out: str,
) -> DataFrame:
    """Latest rate on or before ``at``; 1 within one currency, null when unknown.

    With ``partner`` the book has to be one by partner.
    """
    by = {from_ccy: "from_ccy", to_ccy: "to_ccy"}
    if partner is not None:
        by = {partner: "seq_ttoo", **by}
    found = asof_lookup(rows, book, by, at, {"rate": f"__{out}"})
    rate = F.when(F.col(from_ccy) == F.col(to_ccy), F.lit(1.0)).otherwise(F.col(f"__{out}"))
    return found.select(*rows.columns, rate.alias(out))


def triangulated_rate(
    rows: DataFrame,
    book: Intervals,
    partner: str | None,
    from_ccy: str,
    to_ccy: str,
    at: str,
    out: str,
    pivot: str = EURO,
) -> DataFrame:
    """``partner_rate``, falling back to the two legs through ``pivot``."""
    via, direct = f"__{out}_via", f"__{out}_direct"
    first, second = f"__{out}_first", f"__{out}_second"
    legs = rows.withColumn(via, F.lit(pivot))
    legs = partner_rate(legs, book, partner, from_ccy, to_ccy, at, direct)
    legs = partner_rate(legs, book, partner, from_ccy, via, at, first)
    legs = partner_rate(legs, book, partner, via, to_ccy, at, second)
    rate = F.coalesce(F.col(direct), F.col(first) * F.col(second))
    return legs.select(*rows.columns, rate.alias(out))


def asof_converter(rates: DataFrame, pivot: str | None = EURO) -> Converter:
    """Converter over an effective-dated history; an unknown rate is null."""
    book = rate_book(rates)

    def convert(df: DataFrame, from_ccy: str, to_ccy: str | None, at: str, out: str) -> DataFrame:
        if to_ccy is None:
            euro = df.withColumn(f"__{out}_euro", F.lit(EURO))
            rated = partner_rate(euro, book, None, from_ccy, f"__{out}_euro", at, out)
            return rated.drop(f"__{out}_euro")
        if pivot is None:
            return partner_rate(df, book, None, from_ccy, to_ccy, at, out)
        return triangulated_rate(df, book, None, from_ccy, to_ccy, at, out, pivot)

    return convert


def daily_rate(
    rows: DataFrame, daily: DataFrame, ccy: str, at: str, out: str, missing: float | None = 0.0
) -> DataFrame:
    """Rate of the day for a currency, ``missing`` when there is none.

    Of several rates of one day the largest counts.
    """
    side = daily.groupBy(
        F.col("date").alias(f"__{out}_date"), F.col("currency").alias(f"__{out}_ccy")
    ).agg(F.max(F.col("rate").cast("double")).alias(f"__{out}_rate"))
    match = [F.to_date(F.col(at)) == F.col(f"__{out}_date"), F.col(ccy) == F.col(f"__{out}_ccy")]
    return (
        rows.join(side, match, "left")
        .withColumn(out, F.coalesce(F.col(f"__{out}_rate"), F.lit(missing).cast("double")))
        .drop(f"__{out}_date", f"__{out}_ccy", f"__{out}_rate")
    )


def daily_converter(daily: DataFrame, missing: float | None = 0.0) -> Converter:
    """Converter over one rate per (day, currency) against the euro."""

    default = F.lit(missing).cast("double")

    def convert(df: DataFrame, from_ccy: str, to_ccy: str | None, at: str, out: str) -> DataFrame:
        priced = daily_rate(df, daily, from_ccy, at, f"__{out}_from", None)
        source = F.when(F.col(from_ccy) == EURO, F.lit(1.0)).otherwise(F.col(f"__{out}_from"))
        if to_ccy is None:
            return priced.withColumn(out, F.coalesce(source, default)).drop(f"__{out}_from")
        priced = daily_rate(priced, daily, to_ccy, at, f"__{out}_to", None)
        target = F.when(F.col(to_ccy) == EURO, F.lit(1.0)).otherwise(F.col(f"__{out}_to"))
        cross = F.coalesce(source / F.nullif(target, F.lit(0.0)), default)
        same = F.col(from_ccy) == F.col(to_ccy)
        return priced.withColumn(out, F.when(same, F.lit(1.0)).otherwise(cross)).drop(
            f"__{out}_from", f"__{out}_to"
        )

    return convert


def identity_converter() -> Converter:
    """Every rate is 1: amounts pass through unconverted."""

    def convert(df: DataFrame, from_ccy: str, to_ccy: str | None, at: str, out: str) -> DataFrame:
        return df.withColumn(out, F.lit(1.0))

    return convert


def company_types_at(
    rows: DataFrame, history: Intervals, company: str, purposes: dict[str, str | Column], at: str
) -> DataFrame:
    """``company_rate_types`` from a prepared history; null where there is no type."""
    tag = "__" + "_".join(purposes)
    names = {name: f"{tag}_{name}" for name in RATE_PURPOSE_COLUMNS.values()}
    found = asof_lookup(rows, history, {company: "semp_cod_emp"}, at, names)
    outputs = {}
    for out, purpose in purposes.items():
        wanted = F.col(purpose) if isinstance(purpose, str) else purpose
        picked = F.lit(None).cast("string")
        for code, name in RATE_PURPOSE_COLUMNS.items():
            picked = F.when(wanted == code, F.col(names[name])).otherwise(picked)
        outputs[out] = picked
    return found.withColumns(outputs).drop(*names.values())


def company_rate_types(
    rows: DataFrame,
    company_types: DataFrame,
    company: str,
    purposes: dict[str, str | Column],
    at: str,
    direction: str = FORWARD,
) -> DataFrame:
    """Rate types a company uses at a date, all from one lookup.

    ``purposes`` maps output names to purposes (R, C, L or A; a column name or a column).
    """
    history = intervals(company_types, ["semp_cod_emp"], "fec_aplicacion", direction)
    found = company_types_at(rows, history, company, purposes, at)
    return found.withColumns({out: F.coalesce(out, F.lit(UNKNOWN_RATE_TYPE)) for out in purposes})


def company_rate_type(
    rows: DataFrame,
    company_types: DataFrame,
    company: str,
    purpose: str | Column,
    at: str,
    out: str,
    direction: str = FORWARD,
) -> DataFrame:
    """``company_rate_types`` for one purpose."""
    return company_rate_types(rows, company_types, company, {out: purpose}, at, direction)


def valid_rate_request(
    company: Column, rate_type: Column, at: Column, from_ccy: Column, to_ccy: Column,
    direct: Column | None = None,
) -> Column:
    """Whether a request names everything a rate search needs; never null."""
    direct = F.lit(None).cast("string") if direct is None else direct
    known = rate_type.isNull() | rate_type.isin(*RATE_PURPOSE_COLUMNS)
    route = direct.isNotNull() | (rate_type.isNotNull() & company.isNotNull())
    present = from_ccy.isNotNull() & to_ccy.isNotNull() & at.isNotNull()
    return F.coalesce(known & route & present, F.lit(False))


def spread_percent(
    rows: DataFrame,
    spreads: DataFrame,
    rate_type: str,
    from_ccy: str,
    to_ccy: str,
    at: str,
    kind: str,
    out: str,
) -> DataFrame:
    """Spread in force for sale (V), purchase (C) or fixing (F); 0 when there is none."""
    names = {name: f"__{out}_{name}" for name in SPREAD_COLUMNS.values()}
    by = {rate_type: "tipo_cambio", from_ccy: "cod_div_origen", to_ccy: "cod_div_destino"}
    history = intervals(spreads, list(by.values()), "fec_aplicacion")
    found = asof_lookup(rows, history, by, at, names)
    picked = None
    for code, name in SPREAD_COLUMNS.items():
        value = F.col(names[name]).cast("double")
        picked = F.when(F.col(kind) == code, value) if picked is None else picked.when(
            F.col(kind) == code, value
        )
    return found.withColumn(out, F.coalesce(picked, F.lit(0.0))).drop(*names.values())


def with_spread(amount: Column, pct: Column) -> Column:
    return amount * (1 + pct / 100)


def currency_decimals(rows: DataFrame, currencies: DataFrame, ccy: str, out: str) -> DataFrame:
    """Attach a currency's number of decimals; null for an unknown currency.

    Of several rows of one currency the one with most decimals counts.
    """
    side = currencies.groupBy(F.col("cod_divisa").alias(f"__{out}_ccy")).agg(
        F.max(F.col("decimales").cast("int")).alias(out)
    )
    return rows.join(side, F.col(ccy) == F.col(f"__{out}_ccy"), "left").drop(f"__{out}_ccy")


def round_by_currency(
    rows: DataFrame, currencies: DataFrame, amount: str, ccy: str, out: str
) -> DataFrame:
    """Round an amount to the decimals of its currency."""
    known = currency_decimals(rows, currencies, ccy, f"__{out}_scale")
    return known.withColumn(out, round_to_scale(F.col(amount), F.col(f"__{out}_scale"))).drop(
        f"__{out}_scale"
    )


def currency_exchange(
    rows: DataFrame,
    rates: DataFrame,
    spreads: DataFrame,
    currencies: DataFrame,
    amount: str,
    from_ccy: str,
    to_ccy: str,
    at: str,
    rate_type: str,
    spread_kind: str,
    out: str,
    partner: str | None = None,
    rounded: bool = True,
) -> DataFrame:
    """Full exchange: rate (direct or through the euro), spread, rounding.

    Within one currency neither rate nor spread applies; an unknown rate gives null.
    """
    rate, pct, raw = f"__{out}_rate", f"__{out}_pct", f"__{out}_raw"
    book = rate_book(rates, by_partner=partner is not None)
    priced = triangulated_rate(rows, book, partner, from_ccy, to_ccy, at, rate)
    priced = spread_percent(priced, spreads, rate_type, from_ccy, to_ccy, at, spread_kind, pct)
    value = F.col(amount).cast("double")
    converted = F.when(F.col(from_ccy) == F.col(to_ccy), value).otherwise(
        with_spread(value * F.col(rate), F.col(pct))
    )
    exchanged = priced.withColumn(raw, converted)
    if rounded:
        exchanged = round_by_currency(exchanged, currencies, raw, to_ccy, out)
    else:
        exchanged = exchanged.withColumn(out, F.col(raw))
    return exchanged.drop(rate, pct, raw)
