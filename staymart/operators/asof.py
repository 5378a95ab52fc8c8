"""Effective-dated lookup.

A history is turned into validity intervals, laid on a grid of cells over its own dates: as
many cells as a key has rows on average, of equal length, between its first and its last
percentile; what lies before or after belongs to the end cells. An interval has a row per cell
that it touches, so a history of n rows with k keys has at most 2n + k interval rows, whatever
dates are in it. The lookup is one equi join, on key and cell, with a range check: no window
runs over the driving rows, a hot key is spread over its cells, and a driving row meets the few
intervals of one cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staymart.sources.sinks import write_once

BACKWARD = "backward"
FORWARD = "forward"


def _seconds(ts: Column) -> Column:
    return ts.cast("timestamp").cast("long")


@dataclass(frozen=True)
class Grid:
    """Cells of equal width in seconds."""

    origin: float
    width: float
    cells: int

    def cell(self, moment: Column) -> Column:
        """The cell of a moment; the end cells take what lies outside."""
        step = F.floor((_seconds(moment) - F.lit(self.origin)) / F.lit(self.width))
        inside = F.least(F.greatest(step, F.lit(0)), F.lit(self.cells - 1)).cast("int")
        return F.when(moment.isNotNull(), inside)


@dataclass(frozen=True)
class Intervals:
    """A prepared history, usable for any number of lookups; one row per interval and cell."""

    frame: DataFrame
    grid: Grid
    direction: str

    def stored(self) -> Intervals:
        """The same, written once: every lookup is then planned with the history's true size.

        Spark can't tell it of a history that is summed up from a large table. A small one is
        broadcast and the driving rows stay where they are; they move for a large one only.
        """
        return Intervals(write_once(self.frame), self.grid, self.direction)


def _grid(history: DataFrame, by: Sequence[str], effective: str) -> Grid:
    """The grid of a history, from three numbers that one job over it returns."""
    at = _seconds(F.col(effective))
    found = (
        history.filter(at.isNotNull())
        .agg(
            F.percentile_approx(at, [0.01, 0.99], 1000).alias("ends"),
            F.count(F.lit(1)).alias("rows"),
            F.approx_count_distinct(F.struct(*by)).alias("keys"),
        )
        .first()
    )
    if not found.rows:
        return Grid(0.0, 1.0, 1)
    cells = -(-found.rows // max(found.keys, 1))
    first, last = found.ends
    return Grid(float(first), max(last - first, 1) / cells, cells)


def intervals(
    history: DataFrame,
    by: Sequence[str],
    effective: str,
    direction: str = BACKWARD,
    tie_break: Sequence[str | Column] = (),
    until: str | None = None,
) -> Intervals:
    """Validity intervals of a history.

    Backward rows hold from their date until the next one, forward rows from just
    after the previous date up to their own. Of several rows with one date only
    the last (backward) or first (forward) in ``tie_break`` order holds. Rows without
    a date never hold. ``until`` names a date from which a backward row holds no more.
    The grid comes from a job over the history that runs at once.
    """
    order = Window.partitionBy(*by).orderBy(effective, *tie_break)
    own = F.col(effective)
    if direction == BACKWARD:
        following = F.lead(effective).over(order)
        bounds = {"__lo": own, "__hi": F.least(following, F.col(until)) if until else following}
    else:
        bounds = {"__lo": F.lag(effective).over(order), "__hi": own}
    grid = _grid(history, by, effective)
    first = F.coalesce(grid.cell(F.col("__lo")), F.lit(0))
    last = F.coalesce(grid.cell(F.col("__hi")), F.lit(grid.cells - 1))
    cells = F.sequence(first, last)
    frame = (
        history.filter(own.isNotNull())
        .withColumns(bounds)
        .filter("__lo IS NULL OR __hi IS NULL OR __lo < __hi")
        .withColumn("__cell", F.explode(cells))
    )
    return Intervals(frame, grid, direction)


def asof_lookup(
    rows: DataFrame, history: Intervals, by: dict[str, str], at: str, columns: dict[str, str], how: str = "left"
) -> DataFrame:
    """Left lookup of the history row in force at ``at``.

    ``by`` maps row columns to history columns; ``columns`` maps history values to
    output names. Backward takes the latest date <= ``at``, forward the earliest
    date >= ``at``.
    """
    tag = "__asof_" + "_".join(columns.values())
    lo, hi, moment = F.col(f"{tag}_lo"), F.col(f"{tag}_hi"), F.col(at)
    side = history.frame.select(
        *[F.col(name).alias(f"{tag}_by_{name}") for name in by.values()],
        F.col("__lo").alias(f"{tag}_lo"),
        F.col("__hi").alias(f"{tag}_hi"),
        F.col("__cell").alias(f"{tag}_cell"),
        *[F.col(name).alias(output) for name, output in columns.items()],
    )
    match = [F.col(name) == F.col(f"{tag}_by_{other}") for name, other in by.items()]
    match.append(F.col(f"{tag}_at") == F.col(f"{tag}_cell"))
    if history.direction == BACKWARD:
        match.append((lo <= moment) & (hi.isNull() | (moment < hi)))
    else:
        match.append((moment <= hi) & (lo.isNull() | (lo < moment)))
    # The intervals of a key don't overlap, so a row meets one of them at most.
    found = rows.withColumn(f"{tag}_at", history.grid.cell(moment)).join(side, match, how)
    return found.select(*rows.columns, *columns.values())
