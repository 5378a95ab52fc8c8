"""Approximate nearest neighbours by inner product, with robust-pruned graphs over shards.

Vectors are dealt into shards of about ``SHARD`` by a hash of their id. Each shard's task adds
its distinct vectors in batches: greedy beam searches of the graph so far propose neighbours,
relaxed distance pruning (factor ALPHA) keeps up to DEGREE diverse ones, and edges are made
both ways. Equal vectors share a node, so a very common vector costs one. For the graph a
vector gets one more coordinate that makes all lengths equal; the order by distance is then
the order by inner product.

Lengths within a graph differ by a factor of LONGER at most: a shard's vectors are cut into
bands of length, from the longest down, each with a graph of its own. Vectors of bands of
fewer than FEW are compared with every query. All is in double precision, on vectors scaled by
powers of two, so that no length overflows; a score beyond the range of doubles is infinite.

A graph is one row of bytes. Query vectors are packed in blocks of BLOCK; each block meets
each graph in a task, which searches by inner product with a beam, scores what it found on the
original vectors, and returns its best. Per query the best of all graphs stay. As a hash deals the
vectors, a shard of S holds k / S of a query's k nearest, seldom three deviations more: the beam
has a part that finds the way and one in proportion to that number (``shard_beam``).

Vectors that are null, zero, or hold a null or a non-finite number take no part, nor do rows
without an id; vectors of another dimension are another space. Ties go to the smaller id. A
query has fewer results if there are fewer other rows. Other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import keep

SHARD, BLOCK = 8192, 1024
DEGREE, BEAM, ALPHA = 24, 36, 1.2
SEARCH_BEAM = 160
LONGER, FEW = 8, 256
_BATCH, _EXPAND, _POOL = 256, 4, 48
_UNMET = 65535
_WAY = 0.4  # of the beam


@dataclass
class Graph:
    points: np.ndarray  # with the extra coordinate, but to search by inner product
    edges: np.ndarray  # int32, -1 where there is none
    entry: int

    def search(self, queries: np.ndarray, beam: int, inner: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances) of the ``beam`` nearest found per query; -1 and inf pad.

        With ``inner`` the negative inner product stands for the distance.
        """
        q, rows = len(queries), np.arange(len(queries))[:, None]
        nodes = np.full((q, beam), -1, np.int64)
        far = np.full((q, beam), np.inf)
        done = np.ones((q, beam), bool)
        nodes[:, 0], done[:, 0] = self.entry, False
        far[:, 0] = -(queries @ self.points[self.entry]) if inner else ((queries - self.points[self.entry]) ** 2).sum(1)
        # Per query and node the column that it was met in, of those looked at in one step.
        met = np.full((q, len(self.points)), _UNMET, np.uint16)
        met[:, self.entry] = 0
        active = np.arange(q)
        while len(active):
            waiting = np.where(done[active], np.inf, far[active])
            width = min(_EXPAND, beam)
            pick = np.argpartition(waiting, width - 1, 1)[:, :width]
            good = np.isfinite(np.take_along_axis(waiting, pick, 1))
            some = good.any(1)
            active, pick, good = active[some], pick[some], good[some]
            if not len(active):
                break
            a = active[:, None]
            done[a, pick] |= good
            new = self.edges[nodes[a, np.where(good, pick, 0)]]
            new[~good] = -1
            new = new.reshape(len(active), -1)
            fresh = (new >= 0) & (met[a, new] == _UNMET)
            at, col = np.nonzero(fresh)
            # The same node may come from two of the expanded ones: one column stays.
            met[active[at], new[at, col]] = col
            once = met[active[at], new[at, col]] == col
            at, col = at[once], col[once]
            found = new[at, col]
            counts = np.bincount(at, minlength=len(active))
            place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            wide = (len(active), int(counts.max(initial=0)))
            d, fresh_nodes = np.full(wide, np.inf), np.full(wide, -1, np.int64)
            fresh_nodes[at, place] = found
            if inner:
                d[at, place] = -np.einsum("ij,ij->i", self.points[found], queries[active[at]])
            else:
                gap = self.points[found] - queries[active[at]]
                d[at, place] = np.einsum("ij,ij->i", gap, gap)
            all_far = np.hstack([far[active], d])
            all_nodes = np.hstack([nodes[active], fresh_nodes])
            all_done = np.hstack([done[active], fresh_nodes < 0])
            best = np.argpartition(all_far, beam - 1, 1)[:, :beam]
            far[active] = np.take_along_axis(all_far, best, 1)
            nodes[active] = np.take_along_axis(all_nodes, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
        nodes[~np.isfinite(far)] = -1
        order = np.argsort(far, 1, kind="stable")
        return nodes[rows, order], far[rows, order]


def prune(points: np.ndarray, centre: np.ndarray, pool: np.ndarray, far: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning: rows of ``pool`` (node numbers by distance, -1 pads) cut to ``degree``.

    A neighbour is kept unless a nearer kept one is closer to it, by the factor alpha, than
    the centre is.
    """
    m, width = pool.shape
    # Seen from the centre, so that gaps far smaller than the vectors keep their precision.
    vectors = points[np.maximum(pool, 0)] - points[centre][:, None]
    norms = np.einsum("mwd,mwd->mw", vectors, vectors)
    between = norms[:, :, None] + norms[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    open_ = (pool >= 0) & (pool != centre[:, None])
    count = np.zeros(m, int)
    out = np.full((m, degree), -1, np.int32)
    for i in range(width):
        take = open_[:, i] & (count < degree)
        rows = np.flatnonzero(take)
        out[rows, count[rows]] = pool[rows, i]
        count[rows] += 1
        open_[rows] &= alpha * alpha * between[rows, i] > far[rows]
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 3) -> Graph:
    n = len(points)
    middle = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    # Half as many slots again, so that few back edges make a node be pruned at once.
    graph = Graph(points, np.full((n, degree + degree // 2), -1, np.int32), middle)
    order = np.random.Generator(np.random.PCG64(seed)).permutation(n)
    order = order[order != middle]
    at = 0
    while at < len(order):
        batch = order[at : at + min(_BATCH, max(1, at))]
        at += len(batch)
        nodes, far = graph.search(points[batch], beam)
        # Points of one batch may be each other's neighbours too.
        gaps = _gaps(points[batch])
        np.fill_diagonal(gaps, np.inf)
        near = np.argsort(gaps, 1)[:, : min(8, len(batch) - 1)]
        gap = points[batch[near]] - points[batch][:, None]
        pool = np.hstack([nodes, batch[near]])
        d = np.hstack([far, np.einsum("ijk,ijk->ij", gap, gap)])
        rank = np.argsort(d, 1, kind="stable")
        pool, d = np.take_along_axis(pool, rank, 1), np.take_along_axis(d, rank, 1)
        graph.edges[batch, :degree] = prune(points, batch, pool, d, degree, alpha)
        _link_back(graph, batch, degree, alpha)
    return graph


def _gaps(x: np.ndarray) -> np.ndarray:
    norms = (x * x).sum(1)
    return np.maximum(norms[:, None] + norms[None] - 2 * x @ x.T, 0)


def _link_back(graph: Graph, batch: np.ndarray, degree: int, alpha: float) -> None:
    points, edges = graph.points, graph.edges
    slots = edges.shape[1]
    to, of = edges[batch].ravel(), np.repeat(batch, slots)
    to, of = to[to >= 0], of[to >= 0]
    nodes = np.unique(to)
    old = edges[nodes]
    place, slot = np.nonzero(old >= 0)
    ends = np.concatenate([to, nodes[place]])
    starts = np.concatenate([of, old[place, slot]])
    key = np.unique(ends.astype(np.int64) * len(points) + starts)
    ends, starts = key // len(points), key % len(points)
    gap = points[ends] - points[starts]
    d = np.einsum("ij,ij->i", gap, gap)
    rank = np.lexsort((d, ends))
    ends, starts, d = ends[rank], starts[rank], d[rank]
    row = np.searchsorted(nodes, ends)
    col = np.arange(len(ends)) - np.searchsorted(ends, nodes)[row]
    inside = col < _POOL
    pool = np.full((len(nodes), _POOL), -1, np.int64)
    far = np.full((len(nodes), _POOL), np.inf)
    pool[row[inside], col[inside]], far[row[inside], col[inside]] = starts[inside], d[inside]
    few = (pool >= 0).sum(1) <= slots
    edges[nodes[few]] = pool[few, :slots]
    if (~few).any():
        edges[nodes[~few]] = -1
        edges[nodes[~few], :degree] = prune(points, nodes[~few], pool[~few], far[~few], degree, alpha)


def valid(vector: str) -> Column:
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0)


_PACKED = "dim int, shard int, ids binary, members binary, vectors binary, edges binary, entry int"


def _exponents(x: np.ndarray) -> np.ndarray:
    """Per row the power of two that its largest number is just below."""
    return np.frexp(np.abs(x).max(1))[1]


def _bands(x: np.ndarray) -> list[np.ndarray]:
    """Rows of ``x`` by bands of length, from the longest down."""
    e = _exponents(x)
    log = e + np.log2(np.sqrt((np.ldexp(x, -e[:, None]) ** 2).sum(1)))
    order = np.argsort(-log, kind="stable")
    bands, at = [], 0
    while at < len(order):
        end = int(np.searchsorted(-log[order], np.log2(LONGER) - log[order[at]], "right"))
        bands.append(np.sort(order[at:end]))
        at = end
    return bands


def _pack_shard(key: tuple, table: pa.Table) -> pa.Table:
    """A row per graph, and one without edges for the vectors that are in none."""
    dim, shard = key[0].as_py(), key[1].as_py()
    ids = table["vec_id"].to_numpy()
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["x"].chunks]).reshape(-1, dim)
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    distinct, of = np.unique(x, axis=0, return_inverse=True)
    bands = _bands(distinct)
    few = [band for band in bands if len(band) < FEW]
    packed = [(band, True) for band in bands if len(band) >= FEW]
    if few:
        packed.append((np.concatenate(few), False))
    rows: dict[str, list] = {name: [] for name in ("ids", "members", "vectors", "edges", "entry")}
    for nodes, linked in packed:
        edges, entry = b"", 0
        if linked:
            scaled = np.ldexp(distinct[nodes], -_exponents(distinct[nodes]).max())
            lengths = np.einsum("ij,ij->i", scaled, scaled)
            graph = build(np.column_stack([scaled, np.sqrt(lengths.max() - lengths)]))
            edges, entry = graph.edges.tobytes(), graph.entry
        place = np.full(len(distinct), -1, np.int32)
        place[nodes] = np.arange(len(nodes))
        member = place[of.ravel()]
        rows["ids"].append(ids[member >= 0].astype(np.int64).tobytes())
        rows["members"].append(member[member >= 0].tobytes())
        rows["vectors"].append(distinct[nodes].tobytes())
        rows["edges"].append(edges)
        rows["entry"].append(entry)
    head = {"dim": pa.array([dim] * len(packed), pa.int32()), "shard": pa.array([shard] * len(packed), pa.int32())}
    return pa.table(head | rows | {"entry": pa.array(rows["entry"], pa.int32())})


def shard_beam(shards: int, k: int, beam: int) -> int:
    """The beam in one of ``shards`` shards, where ``beam`` is that for a single one."""
    share = k / shards
    here = min(k, share + 3 * share**0.5)
    return math.ceil(beam * (_WAY + (1 - _WAY) * here / k))


def _best_of_shard(row: dict, k: int, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) for every query of the block."""
    dim = row["dim"]
    ids = np.frombuffer(row["ids"], np.int64)
    x = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
    of = np.frombuffer(row["members"], np.int32)
    by_node = np.argsort(of, kind="stable")  # members of a node, by id
    first = np.searchsorted(of[by_node], np.arange(len(x) + 1))
    q_ids = np.frombuffer(row["q_ids"], np.int64)
    q = np.frombuffer(row["q_vectors"], np.float64).reshape(-1, dim)
    q_power, power = _exponents(q), _exponents(x)
    q = np.ldexp(q, -q_power[:, None])
    nodes = None
    if row["edges"]:
        power[:] = power.max()
    x = np.ldexp(x, -power[:, None])
    if row["edges"]:
        graph = Graph(x, np.frombuffer(row["edges"], np.int32).reshape(len(x), -1), row["entry"])
        nodes, _ = graph.search(q, min(beam, len(x)), inner=True)
    for i in range(len(q)):
        found = np.arange(len(x)) if nodes is None else nodes[i][nodes[i] >= 0]
        with np.errstate(over="ignore"):
            scores = np.ldexp((x[found] * q[i]).sum(1), power[found] + q_power[i])
        rank = np.argsort(-scores, kind="stable")
        got, values, have = [], [], 0
        for j in rank.tolist():
            if have > k and scores[j] < values[-1][0]:
                break
            node = found[j]
            mine = ids[by_node[first[node] : min(first[node + 1], first[node] + k + 1)]]
            mine = mine[mine != q_ids[i]]
            got.append(mine)
            values.append(np.full(len(mine), scores[j]) if len(mine) else np.array([scores[j]])[:0])
            if not len(mine):
                got.pop()
                values.pop()
            have += len(mine)
        if got:
            yield np.full(have, q_ids[i]), np.concatenate(got), np.concatenate(values)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard: int = SHARD,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` (over vec_id) picks its k
    nearest other rows by inner product."""
    v = vectors.where(valid(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")
    )
    v = v.withColumn("dim", F.size("x"))
    spaces = keep(
        v.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(queries, 1)).alias("q"))
        .withColumn("shards", F.ceil(F.col("n") / shard).cast("int"))
        .withColumn("blocks", F.ceil(F.col("q") / BLOCK).cast("int"))
    )
    dealt = v.join(spaces, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
    index = keep(dealt.select("dim", "shard", "vec_id", "x").groupBy("dim", "shard").applyInArrow(_pack_shard, _PACKED))

    def pack_block(key: tuple, table: pa.Table) -> pa.Table:
        x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["x"].chunks])
        return pa.table(
            {
                "dim": pa.array([key[0].as_py()], pa.int32()),
                "block": pa.array([key[1].as_py()], pa.int32()),
                "shards": pa.array([table["shards"][0].as_py()], pa.int32()),
                "q_ids": [table["vec_id"].to_numpy().astype(np.int64).tobytes()],
                "q_vectors": [x.tobytes()],
            }
        )

    asked = dealt.where(queries).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks")).cast("int"))
    blocks = keep(
        asked.select("dim", "block", "shards", "vec_id", "x")
        .groupBy("dim", "block")
        .applyInArrow(pack_block, "dim int, block int, shards int, q_ids binary, q_vectors binary")
    )
    meets = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                parts = list(_best_of_shard(row, k, shard_beam(row["shards"], k, max(beam, 2 * k))))
                if parts:
                    q, ids, scores = (np.concatenate(p) for p in zip(*parts, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

    pairs = meets.join(index, ["dim", "shard"])
    pairs = pairs.repartition("dim", "shard", "block")
    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
