"""Booking measures, declared as data and folded in one pass.

A measure says which rollup rows count, which of their sums it takes and which
rate applies. ``fold`` joins the rollup to the header once, attaches only the
rates the requested measures use, and computes all of them in one aggregation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymart.functions.amounts import (
    SCALES,
    TOTAL_AMOUNT,
    exact_sum_sql,
    exchange_date,
    filtered_sum_sql,
    micros_sql,
)
from staymart.functions.codes import (
    COMMISSION_TYPES,
    COST_EXCLUDED,
    EURO,
    GENERAL_REGIME,
    HOTEL_PAY,
    OVERRIDE_TYPES,
    RECHARGE_TYPE,
    SALE_TAX_EXCLUDED,
    SPECIAL_REGIME,
    TTV_EXCLUDED,
    UNTAXED_COMMISSION_TYPE,
    UNTAXED_SALE_TYPE,
    ZERO_COST_TYPE,
)
from staymart.operators.exchange import Converter, currency_decimals
from staymart.operators.lookups import dimension_lookup
from staymart.plans.rollup import ROLLUP_KEY

BOOKING_KEY = ("grec_seq_rec", "seq_reserva")


@dataclass(frozen=True)
class Rate:
    """A rate: source and target currency columns (None = euro) and the date column."""

    name: str
    source: str
    target: str | None
    at: str


LINE_TO_BOOKING = Rate("rate_line", "line_ccy", "gdiv_cod_divisa", "policy_date")
LINE_TO_EURO = Rate("rate_line_eur", "line_ccy", None, "fec_creacion")
RECHARGE_TO_BOOKING = Rate("rate_recharge", "line_ccy", "gdiv_cod_divisa", "fec_creacion")
BOOKING_TO_EURO = Rate("rate_booking_eur", "gdiv_cod_divisa", None, "fec_creacion")
PARTNER_TO_BOOKING = Rate("rate_partner", "cod_divisa_p", "gdiv_cod_divisa", "policy_date")
PARTNER_TO_EURO = Rate("rate_partner_eur", "cod_divisa_p", None, "fec_creacion")

# Rates that depend on the header alone are looked up before lines are joined.
HEADER_RATES = (BOOKING_TO_EURO, PARTNER_TO_BOOKING, PARTNER_TO_EURO)


@dataclass(frozen=True)
class Measure:
    """One output: an amount of ``AMOUNTS``, the rows that count, and a rate if any."""

    output: str
    amount: str
    counts: str | None = None
    rate: Rate | None = None
    source: str | None = None


def of(source: str, measures: Sequence[Measure]) -> list[Measure]:
    """The same measures, over the rows of one source in a stack of rollups."""
    return [replace(measure, source=source) for measure in measures]


# Sale lines by payment mode: billable ones, or all but CH when paid at the hotel.
_PAYABLE = (
    "(ind_tippag IS NULL AND billable) OR (ind_tippag IS NOT NULL AND record_type <> 'CH')"
)
# Cost lines: billable ones, or all when paid at the hotel.
_DUE = "billable OR ind_tippag IS NOT NULL"


def _where(condition: str, amount: str) -> str:
    return f"CASE WHEN {condition} THEN {amount} END"


def _taxed(condition: str, regime: str) -> str:
    return _where(f"({condition}) AND regime = '{regime}'", "tax")


def _scaled_tax(decimals: str) -> str:
    """Unit tax rounded to a currency's decimals, unrounded when these are unknown."""
    arms = " ".join(f"WHEN {scale} THEN unit_tax_{scale}" for scale in SCALES)
    return f"CASE {decimals} {arms} ELSE unit_tax_raw END"


AMOUNTS = {
    "payable_gross": _where(_PAYABLE, "gross"),
    "payable_gn": _taxed(_PAYABLE, GENERAL_REGIME),
    "payable_en": _taxed(_PAYABLE, SPECIAL_REGIME),
    "due_gross": _where(_DUE, "gross"),
    "due_gn": _taxed(_DUE, GENERAL_REGIME),
    "due_en": _taxed(_DUE, SPECIAL_REGIME),
    "billed_gross": _where("billable", "gross"),
    "billed_tax": _where("billable", _scaled_tax("decimales")),
    "billed_tax_eur": _where("billable", _scaled_tax("decimales_eur")),
    "agent_gross": "agent",
    "agent_taxed": "agent_tax",
    "canal_tax": "canal",
    "canco_tax": "canco",
}
SCALED = ("billed_tax", "billed_tax_eur")


def _codes(codes: Sequence[str]) -> str:
    return ", ".join(f"'{code}'" for code in codes)


def _type_in(codes: Sequence[str]) -> str:
    return f"record_type IN ({_codes(codes)})"


def _type_not_in(codes: Sequence[str]) -> str:
    return f"record_type NOT IN ({_codes(codes)})"


_TTV = _type_not_in(TTV_EXCLUDED)
_SALE_TAX = _type_not_in([*SALE_TAX_EXCLUDED, UNTAXED_SALE_TYPE])
_COMMISSION = _type_in(COMMISSION_TYPES)
_COMMISSION_TAX = _type_in([c for c in COMMISSION_TYPES if c != UNTAXED_COMMISSION_TYPE])
_OVERRIDE = _type_in(OVERRIDE_TYPES)
_COST = _type_not_in([*COST_EXCLUDED, ZERO_COST_TYPE])
_COST_TAX = _type_not_in(COST_EXCLUDED)
_RECHARGE = _type_in([RECHARGE_TYPE])

TTV = [
    Measure("TTV_booking_currency", "payable_gross", _TTV),
    Measure("TTV_EUR_currency", "payable_gross", _TTV, BOOKING_TO_EURO),
]
TAX_TTV = [
    Measure("tax_ttv", "payable_gn", _SALE_TAX),
    Measure("tax_ttv_eur", "payable_gn", _SALE_TAX, BOOKING_TO_EURO),
]
TAX_TTV_TOMS = [
    Measure("tax_ttv_toms", "payable_en", _SALE_TAX),
    Measure("Tax_TTV_EUR_TOMS", "payable_en", _SALE_TAX, BOOKING_TO_EURO),
]
# Sale lines have no currency of their own: they are in the booking's.
CLIENT_COMMISSION = [
    Measure("Client_Commision", "billed_gross", _COMMISSION),
    Measure("Client_EUR_Commision", "billed_gross", _COMMISSION, BOOKING_TO_EURO),
    Measure("Tax_Client_commision", "billed_tax", _COMMISSION_TAX),
    Measure("Tax_Client_EUR_commision", "billed_tax", _COMMISSION_TAX, BOOKING_TO_EURO),
]
CLIENT_RAPPEL = [
    Measure("client_rappel", "billed_gross", _OVERRIDE),
    Measure("Client_EUR_rappel", "billed_gross", _OVERRIDE, BOOKING_TO_EURO),
    Measure("tax_client_rappel", "billed_tax", _OVERRIDE),
    Measure("tax_Client_EUR_rappel", "billed_tax", _OVERRIDE, BOOKING_TO_EURO),
]
SALE = [*TTV, *TAX_TTV, *TAX_TTV_TOMS, *CLIENT_COMMISSION, *CLIENT_RAPPEL]

COST = [
    Measure("cost_booking_currency", "due_gross", _COST, LINE_TO_BOOKING),
    Measure("cost_eur_currency", "due_gross", _COST, LINE_TO_EURO),
    Measure("tax_cost", "due_gn", _COST_TAX, LINE_TO_BOOKING),
    Measure("tax_cost_EUR", "due_gn", _COST_TAX, LINE_TO_EURO),
    Measure("tax_cost_TOMS", "due_en", _COST_TAX, LINE_TO_BOOKING),
    Measure("tax_cost_EUR_TOMS", "due_en", _COST_TAX, LINE_TO_EURO),
]
RECHARGE = [
    Measure("dr_cost", "billed_gross", _RECHARGE, RECHARGE_TO_BOOKING),
    Measure("dr_cost_EUR", "billed_gross", _RECHARGE, LINE_TO_EURO),
]
HOTEL_PAYMENT = [
    measure
    for item in HOTEL_PAY
    for measure in (
        Measure(item.gross, "billed_gross", _type_in([item.code]), LINE_TO_BOOKING),
        Measure(item.tax, "billed_tax", _type_in([item.code]), LINE_TO_BOOKING),
        Measure(item.gross_eur, "billed_gross", _type_in([item.code]), LINE_TO_EURO),
        Measure(item.tax_eur, "billed_tax_eur", _type_in([item.code]), LINE_TO_EURO),
    )
]

AGENT = [
    Measure("GSA_Commision", "agent_gross", None, PARTNER_TO_BOOKING),
    Measure("GSA_EUR_Commision", "agent_gross", None, PARTNER_TO_EURO),
    Measure("Tax_GSA_Commision", "agent_taxed", None, PARTNER_TO_BOOKING),
    Measure("Tax_GSA_EUR_Commision", "agent_taxed", None, PARTNER_TO_EURO),
]
COMPONENT = [
    Measure("canal", "canal_tax"),
    Measure("canal_EUR", "canal_tax", None, BOOKING_TO_EURO),
    Measure("canco", "canco_tax"),
    Measure("canco_EUR", "canco_tax", None, BOOKING_TO_EURO),
]


def measure_header(
    booking: DataFrame,
    interface: DataFrame,
    currencies: DataFrame,
    measures: Sequence[Measure],
    carry: Sequence[str] = (),
    receptive: DataFrame | None = None,
) -> DataFrame:
    """What the given measures need to know about a booking, one narrow row each.

    With ``receptive`` also what decides between rates: partner_ttoo, that of the interface,
    and rate_company, that of the invoicing office.
    """
    policy = any(measure.rate and measure.rate.at == "policy_date" for measure in measures)
    scaled = "decimales" in carry or any(measure.amount in SCALED for measure in measures)
    header = booking.select(
        *BOOKING_KEY,
        "fint_cod_interface",
        "fec_creacion",
        "fec_desde",
        "gdiv_cod_divisa",
        "ind_tippag",
        "cod_divisa_p",
        *(["seq_rec_hbeds"] if receptive is not None else []),
    )
    columns = {"ind_fec_cam_div": "ind_fec_cam_div"} if policy else {}
    if receptive is not None:
        columns["partner_ttoo"] = "partner_ttoo"
        office = {"semp_cod_emp": "rate_company"}
        header = dimension_lookup(header, receptive, "seq_rec_hbeds", "seq_rec", office)
    if columns:
        header = dimension_lookup(header, interface, "fint_cod_interface", "cod_interface", columns)
    if policy:
        header = header.withColumn(
            "policy_date",
            exchange_date(F.col("ind_fec_cam_div"), F.col("fec_desde"), F.col("fec_creacion")),
        )
    if scaled:
        euro = currencies.filter(F.col("cod_divisa") == EURO).agg(
            F.max(F.col("decimales").cast("int"))
        )
        header = currency_decimals(
            header, currencies, "gdiv_cod_divisa", "decimales"
        ).withColumn("decimales_eur", euro.scalar())
    return header


def stack_rollups(rollups: Mapping[str, DataFrame]) -> DataFrame:
    """Rollups under one another, told apart by ``source``."""
    tagged = [frame.withColumn("source", F.lit(name)) for name, frame in rollups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _rows_that_count(measure: Measure) -> str:
    tests = [f"source = '{measure.source}'"] if measure.source else []
    tests += [measure.counts] if measure.counts else []
    return " AND ".join(tests)


def _one_kind(measure: Measure, kinds: Sequence[str]) -> bool:
    """Whether the rows that count are all of one source and record type."""
    one_type = re.fullmatch(r"record_type IN \('[^']*'\)", measure.counts or "")
    return bool(one_type or "record_type" not in kinds) and bool(measure.source or "source" not in kinds)


# Columns of a rollup that the conditions of measures are about.
KINDS = ("source", "record_type")

UNRATED = ("null", "skip", "raise")


def attach_rates(rows: DataFrame, rates: Sequence[Rate], convert: Converter | None) -> DataFrame:
    """Rates under their names, all at once if the converter can."""
    if hasattr(convert, "attach"):
        return convert.attach(rows, [(r.name, r.source, r.target, r.at) for r in rates])
    for rate in rates:
        rows = convert(rows, rate.source, rate.target, rate.at, rate.name)
    return rows


def _flags(tests: Sequence[str]) -> str:
    """SQL text of a number whose bit i tells whether test i holds."""
    return " | ".join(f"CASE WHEN {test} THEN {1 << i}L ELSE 0L END" for i, test in enumerate(tests)) or "0L"


def _missing(measures: Sequence[Measure]) -> dict[tuple[str, Rate], str]:
    """(amount, rate) -> test whether a row with ``__amount`` columns has an amount and no rate for it."""
    pairs = dict.fromkeys((measure.amount, measure.rate) for measure in measures if measure.rate)
    return {(amount, rate): f"{rate.name} IS NULL AND __{amount} <> 0" for amount, rate in pairs}


def fold(
    header: DataFrame,
    rollup: DataFrame,
    measures: Sequence[Measure],
    convert: Converter | None = None,
    carry: Sequence[str] = (),
    unrated: str = "null",
) -> DataFrame:
    """All measures per booking; 0 where nothing counts, every booking kept.

    A measure with an amount for which there is no rate is null, as what could be added up
    is not the total; ``unrated`` = "skip" leaves such amounts out, "raise" fails.
    ``carry`` names header columns to pass through.
    """
    if unrated not in UNRATED:
        raise ValueError(f"unrated is one of {UNRATED}")
    used = {measure.rate.name: measure.rate for measure in measures if measure.rate}
    early = [rate for rate in HEADER_RATES if rate.name in used]
    late = [rate for rate in used.values() if rate not in HEADER_RATES]
    conditions = dict.fromkeys(_rows_that_count(measure) for measure in measures)
    if all(conditions):
        rollup = rollup.filter(" OR ".join(f"({condition})" for condition in conditions))
    rows = attach_rates(header, early, convert)
    match = [F.col(key) == F.col(line) for key, line in zip(BOOKING_KEY, ROLLUP_KEY, strict=True)]
    rows = attach_rates(rows.join(rollup, match, "left"), late, convert)

    kinds = [kind for kind in KINDS if kind in rollup.columns]
    rated = [measure for measure in measures if measure.rate and unrated != "skip"]
    bit = {pair: i for i, pair in enumerate(_missing(rated))}
    flags = _flags(list(_missing(rated).values()))
    passed = [*carry, *[rate.name for rate in early]]
    pairs = dict.fromkeys((m.amount, m.rate if m.rate in late else None) for m in measures)
    parts = {pair: f"__part_{i}" for i, pair in enumerate(pairs)}
    # Step by step, each naming what the next one takes: an amount spelled out wherever it is used makes
    # methods too large to be compiled.
    named = {amount: f"__{amount}" for amount in dict.fromkeys(amount for amount, _ in parts)}
    rows = rows.withColumns({name: F.expr(AMOUNTS[amount]) for amount, name in named.items()})
    if late:
        # First one row per kind of lines, with the few amounts that all measures share. A measure
        # over one kind then picks a row: fewer fields than a sum has, too many are not compiled.
        priced = {name: (named[amount], rate) for (amount, rate), name in parts.items() if rate}
        rows = rows.withColumns(
            {name: F.expr(f"CAST({amount} AS DOUBLE) * {rate.name}") for name, (amount, rate) in priced.items()}
        )
        rows = rows.withColumns({name: F.expr(micros_sql(name)) for name in priced})
        sums = {
            name: exact_sum_sql(name) if name in priced else filtered_sum_sql(named[amount])
            for (amount, _), name in parts.items()
        }
        rows = rows.groupBy(*BOOKING_KEY, *kinds).agg(
            *[F.expr(text).alias(name) for name, text in sums.items()],
            F.bit_or(F.expr(flags)).alias("__missing"),
            *[F.max(name).alias(name) for name in passed],
        )
    else:
        rows = rows.select(
            *BOOKING_KEY,
            *kinds,
            *[F.col(named[amount]).alias(name) for (amount, _), name in parts.items()],
            F.expr(flags).alias("__missing"),
            *passed,
        )
    outputs = [F.max(name).alias(name) for name in carry]
    # What lacks a rate among the rows of each condition, told by the bits of their amounts.
    seen = {condition: f"__missing_{i}" for i, condition in enumerate(dict.fromkeys(map(_rows_that_count, rated)))}
    for condition, name in seen.items():
        where = f" FILTER (WHERE {condition})" if condition else ""
        outputs.append(F.expr(f"bit_or(__missing){where}").alias(name))
    totals, converted, plain = {}, {}, {}
    for measure in measures:
        condition, rate = _rows_that_count(measure), measure.rate
        part = parts[measure.amount, rate if rate in late else None]
        one = late and _one_kind(measure, kinds)
        added = f"max({part}) FILTER (WHERE {condition})" if one else filtered_sum_sql(part, condition)
        # Measures of one total share it.
        totals.setdefault(f"CAST({added} AS {TOTAL_AMOUNT})", f"__total_{len(totals)}")
        total = totals[f"CAST({added} AS {TOTAL_AMOUNT})"]
        if rate in HEADER_RATES:
            converted[measure.output] = (total, rate)
        else:
            plain[measure.output] = total
    outputs += [F.max(rate.name).alias(rate.name) for rate in early]
    folded = rows.groupBy(*BOOKING_KEY).agg(*outputs, *[F.expr(text).alias(name) for text, name in totals.items()])
    # One rate per booking: convert the total.
    folded = folded.withColumns(
        {name: F.expr(f"CAST({total} AS DOUBLE) * {rate.name}") for name, (total, rate) in converted.items()}
    )
    values = {name: f"CAST({micros_sql(name)} AS DECIMAL(19,0)) * 0.000001BD" for name in converted} | plain
    names = [*carry, *[measure.output for measure in measures]]
    places = {m.output: (seen[_rows_that_count(m)], bit[m.amount, m.rate]) for m in rated}

    def value(name: str) -> Column:
        return F.expr(f"CAST(coalesce({values[name]}, 0) AS {TOTAL_AMOUNT})")

    def bad(name: str) -> Column:
        flag, place = places[name]
        return F.coalesce(F.col(flag).bitwiseAND(1 << place) != 0, F.lit(False))

    free = [name for name in names if name not in places]
    kept = [value(name).alias(name) if name in values else F.col(name) for name in free]
    if not places:
        return folded.select(*BOOKING_KEY, *kept)
    # The checked totals pass through one array: Spark compiles a projection with a function over an
    # array in parts, and one of all the tests as a single method, too large for the JVM to compile.
    whole = [F.col(name) for name in BOOKING_KEY]
    where = F.concat(F.lit(": no rate for booking "), *whole)
    checks = F.array(*[F.struct(F.lit(name).alias("name"), bad(name).alias("bad")) for name in places])

    def checked(total: Column, check: Column) -> Column:
        instead = F.raise_error(F.concat(check["name"], where)) if unrated == "raise" else F.lit(None)
        return F.when(check["bad"], instead.cast(TOTAL_AMOUNT)).otherwise(total)

    packed = F.zip_with(F.array(*[value(name) for name in places]), checks, checked)
    folded = folded.select(*BOOKING_KEY, *kept, packed.alias("__checked"))
    at = {name: F.col("__checked")[i].alias(name) for i, name in enumerate(places)}
    return folded.select(*BOOKING_KEY, *[at.get(name, F.col(name)) for name in names])


def unrated_amounts(
    header: DataFrame, rollup: DataFrame, measures: Sequence[Measure], convert: Converter
) -> DataFrame:
    """What measures miss for want of a rate: bookings and amount per measure and currency.

    The rates come with the rows, so nothing is looked up twice; an amount of 0 misses nothing. Rows
    that lack no rate go before the others are told apart by measure.
    """
    used = {measure.rate.name: measure.rate for measure in measures if measure.rate}
    early = [rate for rate in used.values() if rate in HEADER_RATES]
    late = [rate for rate in used.values() if rate not in HEADER_RATES]
    match = [F.col(key) == F.col(line) for key, line in zip(BOOKING_KEY, ROLLUP_KEY, strict=True)]
    rows = attach_rates(attach_rates(header, early, convert).join(rollup, match), late, convert)
    takers = {}
    for measure in measures:
        if measure.rate:
            takers.setdefault(measure.rate.name, set()).add(measure.source)
    # By rate and source alone: a test of all amounts would be a method too large to be compiled.
    lacking = [
        f"({name} IS NULL" + ("" if None in sources else f" AND source IN ({_codes(sorted(sources))})") + ")"
        for name, sources in takers.items()
    ]
    rows = rows.filter(" OR ".join(lacking))
    found = []
    for measure in measures:
        if not measure.rate:
            continue
        amount, condition = AMOUNTS[measure.amount], _rows_that_count(measure)
        missing = f"{measure.rate.name} IS NULL AND {amount} <> 0"
        found.append(
            F.when(
                F.expr(f"({condition}) AND {missing}" if condition else missing),
                F.struct(
                    F.lit(measure.output).alias("measure"),
                    F.col(measure.rate.source).alias("currency"),
                    F.expr(amount).alias("amount"),
                ),
            )
        )
    rows = rows.select(*BOOKING_KEY, F.explode(F.array_compact(F.array(*found))).alias("m"))
    per_booking = rows.groupBy(*BOOKING_KEY, "m.measure", "m.currency").agg(F.sum("m.amount").alias("amount"))
    return per_booking.groupBy("measure", "currency").agg(
        F.count(F.lit(1)).alias("n_bookings"), F.sum("amount").cast(TOTAL_AMOUNT).alias("amount")
    )


def booking_measures(
    tables: Mapping[str, DataFrame],
    rollup: DataFrame,
    measures: Sequence[Measure],
    convert: Converter | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``fold`` over the bookings of a working set."""
    receptive = tables["receptive"] if hasattr(convert, "context") else None
    header = measure_header(
        tables["booking"], tables["interface"], tables["currency"], measures, carry, receptive
    )
    return fold(header, rollup, measures, convert, carry)
