"""Counts of hashed values in a fixed number of buckets, as one byte each.

They order values by rarity for prefix filters. Any order gives the same result; values that
share a bucket cost time only. A bucket counted once holds a value that stands alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RARITY_BITS = 22
_SLICE_BITS = 12


def _level(n: np.ndarray) -> np.ndarray:
    grown = 128 + np.floor(4 * np.log2(np.maximum(n, 128) / 128))
    return np.minimum(255, np.where(n < 128, n, grown))


def packed(counts: np.ndarray) -> list[pa.Array]:
    """Columns (slice, places, counts) of the counts over 0, a row per slice of buckets that has any.

    A count of more than 65,535 stands as that many.
    """
    there = np.flatnonzero(counts)
    number = there >> _SLICE_BITS
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    offsets = pa.py_buffer((np.append(starts, len(there)) * 2).astype(np.int32))
    places = (there & ((1 << _SLICE_BITS) - 1)).astype(np.uint16)
    few = np.minimum(counts[there], np.iinfo(np.uint16).max).astype(np.uint16)
    binaries = [pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(part)]) for part in (places, few)]
    return [pa.array(number[starts].astype(np.int32)), *binaries]


def packed_levels(frame: DataFrame, bits: int) -> np.ndarray:
    """As ``bucket_levels``, of rows as ``packed`` gives them, from any number of tasks."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = totals.setdefault(number, np.zeros(1 << _SLICE_BITS, np.int64))
                total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint16)
        levels = [_level(total).astype(np.uint8).tobytes() for total in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(totals, pa.int32()), pa.array(levels, pa.binary())], ["slice", "levels"])

    return _joined(frame.repartition("slice").mapInArrow(summed, "slice int, levels binary"), bits)


def bucket_levels(frame: DataFrame, bits: int) -> np.ndarray:
    """A byte per bucket of (bucket, n) that grows with the sum of its n: ``2**bits`` bytes,
    whatever the size of the input."""

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        out = np.zeros(1 << _SLICE_BITS, np.uint8)
        out[table["bucket"].to_numpy() & ((1 << _SLICE_BITS) - 1)] = _level(table["n"].to_numpy())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "levels": pa.array([out.tobytes()], pa.binary())})

    slices = (
        frame.groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .withColumn("slice", F.shiftright("bucket", _SLICE_BITS))
        .groupBy("slice")
        .applyInArrow(packed, "slice int, levels binary")
    )
    return _joined(slices, bits)


def _joined(slices: DataFrame, bits: int) -> np.ndarray:
    out = np.zeros(1 << bits, np.uint8)
    for number, levels in slices.collect():
        out[number << _SLICE_BITS : (number + 1) << _SLICE_BITS] = np.frombuffer(levels, np.uint8)
    return out
