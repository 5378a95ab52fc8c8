"""Amount, tax and rounding expressions.

Numeric policy: a line amount is computed in double precision and quantised once to
whole millionths, a 64-bit integer. Sums add those integers as decimals, so totals are
exact and do not depend on the order in which tasks deliver their rows. Results are
decimals with six places. A line amount of ``LARGEST`` units or more, near the limit of those
integers, fails whatever the session's settings; it is never cut down to fit.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL_AMOUNT = "decimal(28,6)"
PLACES = 6
UNIT = 10**PLACES
LARGEST = 9 * 10**12

# Rounding scales that get their own sum in a line rollup; six places need none.
SCALES = (0, 1, 2, 3, 4, 5)


def _double(value: Column) -> Column:
    return value.cast("double")


def micros_sql(value: str) -> str:
    """SQL text of ``micros``."""
    return (
        f"CASE WHEN abs({value}) >= {LARGEST}D THEN CAST(raise_error('amount too large') AS BIGINT) "
        f"ELSE CAST(rint(({value}) * {UNIT}) AS BIGINT) END"
    )


def micros(value: Column) -> Column:
    """A computed amount in millionths, to the nearest."""
    large = F.abs(_double(value)) >= float(LARGEST)
    return F.when(large, F.raise_error(F.lit("amount too large")).cast("bigint")).otherwise(
        F.rint(_double(value) * UNIT).cast("bigint")
    )


def from_micros(value: Column) -> Column:
    return (value.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-PLACES))).cast(TOTAL_AMOUNT)


def quantise(value: Column) -> Column:
    """A computed amount as a decimal with six places."""
    return from_micros(micros(value))


def exact_sum_sql(amount: str, condition: str | None = None) -> str:
    """SQL text summing amounts in millionths, 64-bit integers, to a decimal; null for an empty group.

    The upper and lower 32 bits are summed as integers of their own, which 2^31 rows can't run over;
    a decimal is made of them once per group, not once per row.
    """
    upper = filtered_sum_sql(f"shiftright({amount}, 32)", condition)
    lower = filtered_sum_sql(f"({amount}) & 4294967295L", condition)
    added = f"(CAST({upper} AS DECIMAL(19,0)) * 4294967296BD + CAST({lower} AS DECIMAL(19,0)))"
    return f"CAST({added} * 0.000001BD AS {TOTAL_AMOUNT})"


def filtered_sum_sql(value: str, condition: str | None = None) -> str:
    """SQL text of a sum; rows outside ``condition`` do not touch its buffer."""
    return f"sum({value}) FILTER (WHERE {condition})" if condition else f"sum({value})"


def total(value: Column) -> Column:
    """Sum that is 0, not null, for an empty group."""
    return F.coalesce(F.sum(value), F.lit(0)).cast(TOTAL_AMOUNT)


def rounded_unit_sql(size: str, scale: int) -> str:
    """SQL text rounding a size in millionths HALF_UP to a number of places, in units."""
    return f"(floor({size} / {10 ** (PLACES - scale)}D + 0.5D) / {10**scale}D)"


def service_days(start: Column, end: Column, unit_type: Column, days: Column | None = None) -> Column:
    """Nights for unit type N, calendar days for S, one otherwise; a non-zero ``days`` wins."""
    nights = F.datediff(F.to_date(end), F.to_date(start))
    # The nights are spelled out once: a projection of lines is too large to be compiled otherwise.
    more = F.when(unit_type == "S", 1).otherwise(0)
    counted = F.when(unit_type.isin("N", "S"), nights + more).otherwise(1)
    if days is None:
        return counted
    return F.when(days.isNotNull() & (days != 0), days).otherwise(counted)


def service_quantity(units: Column, pax: Column, ps_flag: Column) -> Column:
    """Passengers for flag P, units otherwise."""
    return F.when(ps_flag == "P", pax).otherwise(units)


def service_factor(start: Column, end: Column, days: Column, quantity: Column) -> Column:
    """Days x quantity; 0 when a service date is missing."""
    return F.when(start.isNull() | end.isNull(), F.lit(0)).otherwise(days * quantity)


def night_amount(
    start: Column,
    end: Column,
    units: Column,
    pax: Column,
    unit_type: Column,
    ps_flag: Column,
    unit_amount: Column,
    days: Column | None = None,
) -> Column:
    """Amount of a service line over its nights or days."""
    factor = service_factor(
        start,
        end,
        service_days(start, end, unit_type, days),
        service_quantity(units, pax, ps_flag),
    )
    return F.when(factor == 0, F.lit(0.0)).otherwise(_double(unit_amount) * factor)


def contained_tax(gross: Column, pct: Column) -> Column:
    """Tax inside a tax-inclusive amount."""
    gross, pct = _double(gross), _double(pct)
    return gross - gross / (1 + pct / 100)


def tax_share(pct: Column) -> Column:
    """Fraction of a tax-inclusive amount that is tax."""
    return 1 - 1 / (1 + _double(pct) / 100)


def canal_tax(regime: Column, margin: Column, sale: Column, pct_sale: Column, pct_buy: Column) -> Column:
    """Channel tax of one component line: on the margin for regime E, else sale less purchase."""
    margin, sale = _double(margin), _double(sale)
    return F.when(regime == "E", margin * tax_share(pct_sale)).otherwise(
        sale * tax_share(pct_sale) - (sale - margin) * tax_share(pct_buy)
    )


def canco_tax(regime: Column, margin: Column, cost: Column, pct_sale: Column, pct_buy: Column) -> Column:
    """Channel-company tax of one component line, built up from the cost."""
    margin, cost = _double(margin), _double(cost)
    return F.when(regime == "E", margin * tax_share(pct_sale)).otherwise(
        (cost + margin) * tax_share(pct_sale) - cost * tax_share(pct_buy)
    )


def round_to_scale(amount: Column, decimals: Column) -> Column:
    """HALF_UP rounding to a per-row number of decimals; unknown decimals leave the amount alone."""
    exact = amount.cast(TOTAL_AMOUNT)
    rounded = F.when(decimals == SCALES[0], F.round(exact, SCALES[0]).cast(TOTAL_AMOUNT))
    for scale in SCALES[1:]:
        rounded = rounded.when(decimals == scale, F.round(exact, scale).cast(TOTAL_AMOUNT))
    return rounded.otherwise(exact)


def exchange_date(policy: Column, service_from: Column, created: Column) -> Column:
    """Date whose rate applies: service start for policy E, creation otherwise."""
    return F.when(policy == "E", service_from).otherwise(created)
