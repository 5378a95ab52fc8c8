"""Two formulations of the same measures, held against each other booking by booking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING, EXTRA, EQUAL, CLOSE, DIFFERENT = "missing", "extra", "equal", "close", "different"


def reconcile(
    stored: DataFrame,
    computed: DataFrame,
    keys: Sequence[str],
    pairs: Mapping[str, tuple[str, str]],
    absolute: float = 0.005,
    relative: float = 0.0,
) -> DataFrame:
    """(keys, measure, stored, computed, difference, verdict), a row per booking and measure.

    ``pairs`` maps a name to its stored and its computed column. A booking that is only stored
    is missing from the computed side, one only computed is extra; else two values are equal
    (two nulls too), close (apart by ``absolute`` or by ``relative`` of the stored amount, at
    most) or different, as a null and a value are. Null keys are keys like others.
    """
    sides = []
    for frame, tag, at in ((stored, "s", 0), (computed, "c", 1)):
        sides.append(
            frame.select(
                *[F.col(key).alias(f"__{tag}_{key}") for key in keys],
                F.lit(True).alias(f"__{tag}"),
                *[F.col(pair[at]).cast("double").alias(f"__{tag}_value_{name}") for name, pair in pairs.items()],
            )
        )
    match = [F.col(f"__s_{key}").eqNullSafe(F.col(f"__c_{key}")) for key in keys]
    both = sides[0].join(sides[1], match, "full")
    own = [F.when(F.col("__s"), F.col(f"__s_{key}")).otherwise(F.col(f"__c_{key}")).alias(key) for key in keys]
    entries = [
        F.struct(F.lit(name).alias("measure"), F.col(f"__s_value_{name}").alias("stored"), F.col(f"__c_value_{name}").alias("computed"))
        for name in pairs
    ]
    rows = both.select(*own, "__s", "__c", F.explode(F.array(*entries)).alias("m")).select(*keys, "__s", "__c", "m.*")
    old, new = F.col("stored"), F.col("computed")
    near = F.abs(new - old) <= F.greatest(F.lit(absolute), F.abs(old) * F.lit(relative))
    verdict = (
        F.when(F.col("__c").isNull(), MISSING)
        .when(F.col("__s").isNull(), EXTRA)
        .when(old.eqNullSafe(new), EQUAL)
        .when(near, CLOSE)
        .otherwise(DIFFERENT)
    )
    return rows.select(*keys, "measure", "stored", "computed", (new - old).alias("difference"), verdict.alias("verdict"))


def reconcile_summary(rows: DataFrame) -> DataFrame:
    """Bookings and the largest difference per measure and verdict."""
    return rows.groupBy("measure", "verdict").agg(
        F.count(F.lit(1)).alias("n_bookings"), F.max(F.abs("difference")).alias("largest")
    )
