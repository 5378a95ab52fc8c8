"""Joins against dimensions and key sets; one row per key.

None of these carries a broadcast hint: a dimension is broadcast when Spark's
size statistics (or the adaptive run-time size) put it under the threshold, and
is shuffled with skew splitting otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: column names of the tax keys ---
TAX_KEYS = ("ind_tipo_imp", "cod_impuesto", "cod_esquema", "cod_clasif", "cod_emp_atlas")
LINE_TAX_KEYS = (
    "rvp_ind_tipo_imp",
    "rvp_cod_impuesto",
    "rvp_cod_esquema",
    "rvp_cod_clasif",
    "rvp_cod_empresa",
)
COMPONENT_TAX_KEYS = (
    "ind_tipo_imp_vta_fac",
    "cod_impuesto_vta_fac",
    "cod_esquema_vta_fac",
    "cod_clasif_vta_fac",
    "cod_empresa_vta_fac",
)
# --- end of fixed values ---

TAX_SALTS = 8
NO_KEY_SALTS = 10_000


def restrict_to_keys(rows: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """Keep rows whose key (left name -> right name) is among ``keys``."""
    wanted = keys.select(*[F.col(right).alias(f"__key_{left}") for left, right in on.items()])
    match = [F.col(left) == F.col(f"__key_{left}") for left in on]
    return rows.join(wanted, match, "left_semi")


def exclude_keys(rows: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """Drop rows whose key is among ``keys``; a null key part never matches."""
    unwanted = keys.select(*[F.col(right).alias(f"__key_{left}") for left, right in on.items()])
    match = [F.col(left) == F.col(f"__key_{left}") for left in on]
    return rows.join(unwanted, match, "left_anti")


def exclude_whole_keys(
    rows: DataFrame, keys: DataFrame, on: dict[str, str], nullable: str
) -> DataFrame:
    """``exclude_keys`` for rows of which most lack the key part ``nullable``.

    These match nothing and pass by the join, so that only rows with a whole key are moved for it.
    """
    whole = exclude_keys(rows.filter(F.col(nullable).isNotNull()), keys, on)
    return whole.unionByName(rows.filter(F.col(nullable).isNull()))


def exclude_keys_not_in(
    rows: DataFrame, keys: DataFrame, on: dict[str, str], nullable: str
) -> DataFrame:
    """Drop rows as SQL's NOT IN does, for keys of which one part may be null in ``rows``.

    A row without that part goes if the rest of its key is among ``keys``: whether the whole
    key is, is unknown. ``keys`` hold no nulls.
    """
    rest = {left: right for left, right in on.items() if left != nullable}
    whole = exclude_keys(rows.filter(F.col(nullable).isNotNull()), keys, on)
    open_ = exclude_keys(rows.filter(F.col(nullable).isNull()), keys, rest)
    return whole.unionByName(open_)


def first_row(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter is evaluated before the shuffle too (window group limit), so
    a key with very many rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def unique_rates(tax: DataFrame) -> DataFrame:
    """Tax percentages with one row per five-part key, so a lookup cannot multiply lines."""
    return tax.groupBy(*TAX_KEYS).agg(F.max("pct_impuesto").alias("pct_impuesto"))


def tax_lookup(
    lines: DataFrame,
    tax: DataFrame,
    line_keys: Sequence[str] = LINE_TAX_KEYS,
    output: str = "pct_impuesto",
    how: str = "left",
    spread_by: Sequence[str] = (),
    salts: int = TAX_SALTS,
) -> DataFrame:
    """Attach the percentage found under the five-part tax key.

    With ``spread_by``, columns that tell lines apart, no key gathers its lines in one task
    where the tax table is too large to be broadcast: lines of a key are dealt over ``salts``
    copies of its row, and lines without a whole key, which match nothing, over all tasks.
    """
    salt, number = f"__{output}_salt", f"__{output}_number"
    rates = unique_rates(tax)
    if spread_by:
        # Grouped after the copying, which shows Spark that a key and number are unique: it
        # leaves out a lookup whose result nobody uses.
        copies = rates.withColumn(number, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rates = copies.groupBy(*TAX_KEYS, number).agg(F.max("pct_impuesto").alias("pct_impuesto"))
    side = rates.select(
        *[F.col(key).alias(f"__{output}_{key}") for key in TAX_KEYS],
        *([number] if spread_by else []),
        F.col("pct_impuesto").alias(f"__{output}"),
    )
    match = [
        F.col(line_key) == F.col(f"__{output}_{key}")
        for line_key, key in zip(line_keys, TAX_KEYS, strict=True)
    ]
    rows = lines
    if spread_by:
        number_of = F.xxhash64(*spread_by)
        whole = reduce(and_, [F.col(key).isNotNull() for key in line_keys])
        # Salts below 0 have no row to meet.
        own = F.when(whole, F.pmod(number_of, F.lit(salts))).otherwise(-1 - F.pmod(number_of, F.lit(NO_KEY_SALTS)))
        rows = lines.withColumn(salt, own.cast("int"))
        match.append(F.col(salt) == F.col(number))
    joined = rows.join(side, match, how)
    return joined.withColumnRenamed(f"__{output}", output).drop(
        salt, number, *[f"__{output}_{key}" for key in TAX_KEYS]
    )


def dimension_lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str | Column,
    dimension_key: str,
    columns: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Attach dimension ``columns`` (dimension name -> output name) under a role.

    Calling it twice with different output names plays the same dimension in two
    roles. Of several rows with one key the smallest by ``columns`` counts, nulls
    first, so a lookup never multiplies rows.
    """
    role = "__role_" + "_".join(columns.values())
    side = one_row(
        dimension.select(
            F.col(dimension_key).alias(role),
            *[F.col(name).alias(output) for name, output in columns.items()],
        ),
        [role],
    )
    left = F.col(key) if isinstance(key, str) else key
    return rows.join(side, left == F.col(role), how).drop(role)


def one_row(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the other columns, nulls first."""
    others = [name for name in rows.columns if name not in keys]
    if not others:
        return rows.distinct()
    return (
        rows.groupBy(*keys)
        .agg(F.min(F.struct(*others)).alias("__row"))
        .select(*keys, *[F.col(f"__row.{name}").alias(name) for name in others])
    )
