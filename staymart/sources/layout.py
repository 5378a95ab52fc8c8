"""Tables clustered by booking, written once for many runs.

Every table of a booking's rows is written as a bucketed table: same number of buckets, by the
booking key under the name it has there. Joins and sums by booking then read matching buckets
and move no line over the network. A bucket is written by one task, so there is a file per
bucket and table; the number of buckets bounds how far a later run spreads, and a bucket's rows
are sorted and summed by one task, so their number should follow the rows (``bucket_count``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from staymart.plans.extract import KEYED_TABLES
from staymart.plans.measures import BOOKING_KEY

#: Table -> names of its columns that hold the booking key, in the key's order.
CLUSTER_KEYS = {
    "booking": BOOKING_KEY,
    **{
        name: tuple(sorted(on, key=lambda column: BOOKING_KEY.index(on[column])))
        for name, on in KEYED_TABLES.items()
    },
}

BUCKET_ROWS = 500_000


def bucket_count(tables: Mapping[str, DataFrame], names: Iterable[str], least: int, rows: int = BUCKET_ROWS) -> int:
    """Buckets for tables that meet: ``least``, or more to hold about ``rows`` of the largest each."""
    largest = max(tables[name].count() for name in names)
    return max(least, -(-largest // rows))


def write_clustered(
    tables: Mapping[str, DataFrame], names: Iterable[str], folder: str, prefix: str, buckets: int
) -> None:
    """Write the named tables as ``prefix_name``, their files under ``folder``."""
    for name in names:
        keys = CLUSTER_KEYS[name]
        # By the buckets' own hash, so that each task holds one bucket.
        dealt = tables[name].repartition(buckets, *keys)
        writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
        writer.option("path", f"{folder.rstrip('/')}/{name}").saveAsTable(f"{prefix}_{name}")


class Clustered(Mapping[str, DataFrame]):
    """A working set in which the clustered tables stand for the ones of ``rest``."""

    def __init__(self, spark: SparkSession, prefix: str, names: Iterable[str], rest: Mapping[str, DataFrame]):
        self.spark, self.prefix, self.names, self.rest = spark, prefix, tuple(names), rest
        #: Tables whose rows need not be dealt out by booking.
        self.clustered = frozenset(self.names)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.names:
            return self.spark.table(f"{self.prefix}_{name}")
        return self.rest[name]

    def __iter__(self) -> Iterator[str]:
        return iter({*self.names, *self.rest})

    def __len__(self) -> int:
        return len({*self.names, *self.rest})
