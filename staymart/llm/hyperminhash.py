"""Near-duplicate documents by HyperMinHash sketches.

A document's set holds hashes (64 bits) of its distinct word shingles; words are cut at ASCII
white space, A-Z in lower case. A text with fewer words is one shingle; one without words has
an empty set and no link. Documents are linked if 100 * intersection >= 80 * union, on whole
sets. Equal sets form a class, known by a 128-bit sum.

The sketch deals hashes to 128 buckets and keeps of each bucket's minimum the count of leading
zeros and the ten bits below, 16 bits a register. Empty registers copy a full one chosen by a
fixed random order, so short texts have full sketches too. 32 bands of four registers make
candidates: two sets at Jaccard 0.8 share none with probability (1 - 0.8**4)**32 < 1e-7. The
Jaccard estimate, corrected for registers that agree by chance, then drops pairs seven
standard deviations below the threshold, and whole sets decide.

Pairs inside a band are never all listed: members are linked to a centre first, and only
pairs whose components still differ follow, so a group of copies costs its size. Those are
found by their rarest shingles, with prefix, length and positional filter, so that copies too
far apart from each other aren't listed in pairs either.

Null ids take no part in links; null texts are empty. Rows sharing an id share its decision.
Other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .rarity import RARITY_BITS, bucket_levels
from .scratch import keep
from .words import Words, mix, words

BUCKETS, BAND, MANTISSA = 128, 4, 10
PERCENT = 80
#: Sets smaller than this have copied registers, whose agreement isn't independent.
FULL_SKETCH = 512
_EMPTY = np.uint16(0xFFFF)
_RANDOM = np.random.Generator(np.random.PCG64(41))
#: For each register the order in which an empty one looks at the others.
_ORDER = np.stack([_RANDOM.permutation(np.delete(np.arange(BUCKETS), i)) for i in range(BUCKETS)], 1)
_FACTORS = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EDGES = (np.arange(BUCKETS, dtype=np.uint64) << np.uint64(57)).astype(np.uint64)


def shingle_sets(chunk: Words, n: int) -> Iterator[np.ndarray]:
    """For each row of the chunk the sorted distinct shingle hashes."""
    h = chunk.hashes
    full = len(h) - n + 1
    if full > 0:
        rolled = np.zeros(full, np.uint64)
        for k in range(n):
            rolled += mix(h[k : k + full] ^ _FACTORS[k]) * _FACTORS[k]
        rolled = mix(rolled)
    bounds = chunk.bounds.tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= n:
            yield np.unique(rolled[a : b - n + 1])
        elif b > a:
            part = mix(h[a:b] ^ _FACTORS[: b - a]) * _FACTORS[: b - a]
            yield mix(np.array([part.sum(dtype=np.uint64) ^ _FACTORS[40 + b - a]]))
        else:
            yield h[:0]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers per set; sets without elements keep empty ones."""
    least = np.zeros((len(sets), BUCKETS), np.uint64)
    there = np.zeros((len(sets), BUCKETS), bool)
    for i, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, _EDGES)
            inside = at < len(s)
            low = s[np.minimum(at, len(s) - 1)]
            there[i] = inside & (low >> np.uint64(57) == np.arange(BUCKETS, dtype=np.uint64))
            least[i] = low << np.uint64(7)
    _, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    zeros = (53 - exponent).astype(np.uint64)
    mantissa = ((least << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    out[~there] = _EMPTY
    rows, cols = np.nonzero(~there & there.any(1)[:, None])
    step = 0
    while len(rows):
        source = _ORDER[step, cols]
        found = there[rows, source]
        out[rows[found], cols[found]] = out[rows[found], source[found]]
        rows, cols = rows[~found], cols[~found]
        step += 1
    return out


def sketches(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(doc_id, n_shingles, c1, c2, bands) per row; c1 and c2 tell the set, null if empty."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words(batch.column(1)):
                sets = list(shingle_sets(chunk, n))
                sizes = np.array([len(s) for s in sets], np.int64)
                one = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                two = np.array([mix(s ^ _FACTORS[0]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                bands = registers(sets).view(np.int64)
                flat = pa.array(bands.ravel())
                ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.rows).cast(pa.int64()),
                        pa.array(sizes),
                        pa.array(one, mask=sizes == 0),
                        pa.array(two, mask=sizes == 0),
                        pa.ListArray.from_arrays(ends, flat),
                    ],
                    ["doc_id", "n_shingles", "c1", "c2", "bands"],
                )

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.mapInArrow(sketch, "doc_id long, n_shingles long, c1 long, c2 long, bands array<long>")


def shingle_table(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(doc_id, shingles) of the ids of ``wanted``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words(batch.column(1)):
                found = list(shingle_sets(chunk, n))
                ends = np.append(0, np.cumsum([len(s) for s in found])).astype(np.int32)
                flat = np.concatenate(found).view(np.int64)
                ids = batch.column(0).slice(chunk.first, chunk.rows).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "shingles"]
                )

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.join(wanted, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, shingles array<long>")


@lru_cache(maxsize=4096)
def chance(log_a: int, log_b: int) -> float:
    """Probability that two unrelated registers agree; bucket loads are 2**(log / 2)."""
    zeros = np.arange(54)[:, None]
    low = 2.0 ** -(zeros + 1) * (1 + np.arange(1 << MANTISSA)[None, :] / (1 << MANTISSA))
    high = low + 2.0 ** -(zeros + 1) / (1 << MANTISSA)

    def mass(load: float) -> np.ndarray:
        return np.exp(load * np.log1p(-low)) - np.exp(load * np.log1p(-np.minimum(high, 1 - 1e-16)))

    return float((mass(2 ** (log_a / 2)) * mass(2 ** (log_b / 2))).sum())


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from rows of registers, without the agreements due to chance."""
    agree = (a == b).mean(1)
    logs = [np.round(2 * np.log2(np.maximum(n / BUCKETS, 1))).astype(int).tolist() for n in (n_a, n_b)]
    by_chance = np.array([chance(x, y) for x, y in zip(*logs, strict=True)])
    return (agree - by_chance) / (1 - by_chance)


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose estimate doesn't rule them out."""
    j = percent / 100
    bound = j - 7 * math.sqrt(j * (1 - j) / BUCKETS)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = (np.stack([np.array(v, np.int64) for v in batch.column(c).to_pylist()]).view(np.uint16) for c in (4, 5))
            n_x, n_y = (batch.column(c).to_numpy() for c in (2, 3))
            stays = (estimates(x, y, n_x, n_y) >= bound) | (np.minimum(n_x, n_y) < FULL_SKETCH)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(stays))

    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("bands").alias("x"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("bands").alias("y"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", "x", "y")
    return both.mapInArrow(judged, "a long, b long")


def _linked(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs that whole sets confirm."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    pairs = _plausible(pairs, classes, percent)
    confirmed = pairs.join(right, "b").join(left, "a").where(shared * 100 >= union * percent)
    return keep(confirmed.select("a", "b"))


def _sizes_fit(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    component_id is the smallest id that links reach; without links, or with a null id, the
    document's own. kept tells whether it is the own one (true for a null id). Rows of one id
    with different texts are one document that has the links of all of them.
    """
    rows = keep(sketches(docs, doc_id, text, shingle))
    classes = keep(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("c1", "c2")
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.count("*").alias("copies"),
        )
    )
    members = classes.select(F.col("rep").alias("u"), "n", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("band", "key").agg(F.count("*").alias("m")).where("m > 1").drop("m")
    members = keep(members.join(shared, ["band", "key"]))
    # An id may stand in several rows: each of its different sets once.
    ids = members.select(F.col("u").alias("doc_id")).distinct()
    sets = shingle_table(docs, ids, doc_id, text, shingle).withColumn("set", F.xxhash64("shingles"))
    sets = keep(sets.dropDuplicates(["doc_id", "set"]).drop("set"))

    links = None
    labels = members.select(F.col("u").alias("node"), F.col("u").alias("component")).where("false")
    for salt in range(2):
        now = _labelled(members, labels)
        near = F.struct(*([F.xxhash64("u", F.lit(salt))] if salt else []), "u", "n", "component")
        centre = now.groupBy("band", "key").agg(F.min(near).alias("c"))
        pairs = (
            now.join(centre, ["band", "key"])
            .where((F.col("c.component") != F.col("component")) & _sizes_fit("n", "c.n", percent))
            .groupBy("u")
            .agg(F.min("c.u").alias("a"))
            .select("a", F.col("u").alias("b"))
        )
        found = _linked(pairs, classes, sets, percent)
        links = found if links is None else links.union(found)
        labels = components(links)

    now = _labelled(members, labels)
    # Links may be unknown only where the members of a group are of several components.
    mixed = now.groupBy("band", "key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    split = now.join(mixed, ["band", "key"], "left_semi")
    pairs = _prefix_pairs(split.select("u", "component").distinct(), sets, percent)
    links = links.union(_linked(pairs, classes, sets, percent))
    labels = components(links)

    of_class = (
        classes.join(labels, classes["rep"] == labels["node"], "left")
        .select("c1", "c2", F.coalesce("component", "rep").alias("component"), "rep", "copies")
        .where("copies > 1 OR component <> rep")
        .select("c1", "c2", "component")
    )
    out = rows.select("doc_id", "n_shingles", "c1", "c2").join(of_class, ["c1", "c2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that may be similar, by the exact prefix filter.

    Shingles are ordered by how many of the ``members`` (u, component) have them, counted in
    buckets; two similar sets share one of the rarest of each.
    """
    held = keep(sets.join(members, sets["doc_id"] == members["u"]).select("u", "component", "shingles"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column(0).flatten().to_numpy().view(np.uint64) >> np.uint64(64 - RARITY_BITS)
            there, n = np.unique(buckets.astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n)], ["bucket", "n"])

    counts = held.select("shingles").mapInArrow(counted, "bucket int, n long")
    shared = members.sparkSession.sparkContext.broadcast(bucket_levels(counts, RARITY_BITS))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy().view(np.uint64)
            sizes = np.diff(batch.column(2).offsets.to_numpy()).astype(np.int64)
            level = shared.value[(values >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, level, row))
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            prefix = sizes - (sizes * percent + 99) // 100 + 1
            pick = (place < prefix[row]) & (level[order] > 1)
            at = pa.array(row[pick])
            columns = [values[order][pick].view(np.int64), sizes[row][pick], place[pick]]
            names = ["h", "n", "place", "u", "component"]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column(0).take(at), batch.column(1).take(at)], names)

    rows = held.mapInArrow(rarest, "h long, n long, place long, u long, component long")
    x, y = (rows.select("h", *(F.col(c).alias(f"{c}_{side}") for c in ("n", "place", "u", "component"))) for side in "xy")
    both = F.col("n_x") + F.col("n_y")
    # What two sets can share from their first common shingle on must reach the overlap needed.
    rest = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    possible = (F.col("u_x") < F.col("u_y")) & (F.col("component_x") != F.col("component_y"))
    possible &= _sizes_fit("n_x", "n_y", percent) & (rest * (100 + percent) >= both * percent)
    return x.join(y, "h").where(possible).select(F.col("u_x").alias("a"), F.col("u_y").alias("b")).distinct()


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, members["u"] == labels["node"], "left").select(
        "band", "key", "u", "n", F.coalesce("component", "u").alias("component")
    )


def without_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one of the smallest id."""
    found = near_duplicates(docs, doc_id, text, shingle, percent)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone_id")).distinct()
    return docs.join(gone, docs[doc_id] == gone["__gone_id"], "left_anti")
