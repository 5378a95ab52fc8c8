"""Document quality by Bradley-Terry pairwise ranking.

Documents labelled 1 are preferred to documents labelled 0. Weights minimise the logistic
loss of feature differences over such pairs, so that a document's score is its log-odds of
being preferred. The cut is the quantile of the labelled scores that leaves the labelled
share of rejected documents below; the published score is the logistic of the distance to it.

The fit sees every labelled document. They are dealt into groups of about ``GROUP`` by a hash of the
id, and the pairs are all those of a good and a bad document of one group; Newton steps, moments and
the cut are sums over the groups, one small row per task. Without both labels every score is 0.5. Null and empty texts have features, and so a score, as any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import dense
from .labelled import labelled
from .scratch import keep

GROUP = 2000
#: Penalty of the weights and steps at most, as for ``fit_pairs``.
PENALTY, STEPS = 1e-3, 30
BINS = 1024


def _inputs(column: pa.Array) -> np.ndarray:
    """Features and, as small rates matter too, their logarithms."""
    x = dense(column)
    return np.hstack([x, np.log(np.maximum(x, 0) + 1e-3)])


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_pairs(better: np.ndarray, worse: np.ndarray, penalty: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Bradley-Terry weights from rows of preferred and less preferred features (Newton)."""
    d = better - worse
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (p - 1) / len(d) + penalty * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _grouped(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str) -> DataFrame:
    """(label, x) of the labelled documents, a row per group, in order of id."""

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _inputs(batch.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], ["doc_id", "x"])

    known = keep(labelled(labels, label, doc_id))
    groups = -(-max(known.count(), 1) // GROUP)
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    kind = kept.schema["doc_id"].dataType.simpleString()
    # Features are narrower than texts, so these stay where they are.
    rows = kept.mapInArrow(featured, f"doc_id {kind}, x array<double>").join(known, "doc_id")
    rows = rows.withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(groups)))

    def pack(group: pa.Table) -> pa.Table:
        x = np.array(group["x"].to_pylist(), np.float64)
        order = np.lexsort((*x.T[::-1], group["doc_id"].to_numpy(zero_copy_only=False)))
        label = group["label"].to_numpy(zero_copy_only=False)[order]
        return pa.table({"label": pa.array([label], pa.list_(pa.int32())), "x": pa.array([x[order].ravel()], pa.list_(pa.float64()))})

    return keep(rows.groupBy("g").applyInArrow(pack, "label array<int>, x array<double>"))


def _sums(groups: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``part``, a flat array, over all groups; None without any. Tasks add theirs up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for label, x in zip(batch.column(0), batch.column(1), strict=True):
                y = label.values.to_numpy()
                found = part(y, x.values.to_numpy().reshape(len(y), -1))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])

    rows = groups.select("label", "x").mapInArrow(run, "total array<double>").toArrow()["total"].to_pylist()
    return np.sum([np.array(row) for row in rows], 0) if rows else None


def _newton(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Pairs, gradient and Hessian of the loss over all pairs of a good and a bad row."""
    good, bad = z[y == 1], z[y == 0]
    p = 1 / (1 + np.exp(-np.clip((good @ w)[:, None] - (bad @ w)[None, :], -30, 30)))
    gradient = good.T @ (p - 1).sum(1) - bad.T @ (p - 1).sum(0)
    v = p * (1 - p)
    mixed = good.T @ v @ bad
    hessian = (good * v.sum(1)[:, None]).T @ good + (bad * v.sum(0)[:, None]).T @ bad - mixed - mixed.T
    return np.concatenate([[p.size], gradient, hessian.ravel()])


def fit(groups: DataFrame) -> Ranking:
    """A ranking from the grouped features of all labelled documents."""
    sums = _sums(groups, lambda y, x: np.concatenate([[len(y), (y == 0).sum(), (y == 1).sum()], x.sum(0), (x * x).sum(0)]))
    if sums is None:
        n = _inputs(pa.array([""])).shape[1]
        return Ranking(np.zeros(n), np.ones(n), np.zeros(n), 0.0)
    (n, bad, good), (mean, square) = sums[:3], np.split(sums[3:], 2) / sums[0]
    scale = np.sqrt(np.maximum(square - mean**2, 0)) + 1e-6
    d, w = len(mean), np.zeros(len(mean))

    def standard(x: np.ndarray) -> np.ndarray:
        return np.clip((x - mean) / scale, -8, 8)

    if not bad or not good:
        return Ranking(mean, scale, w, 0.0)
    for _ in range(STEPS):
        found = _sums(groups, lambda y, x: _newton(standard(x), y, w))
        pairs = max(found[0], 1)
        gradient = found[1 : d + 1] / pairs + PENALTY * w
        step = np.linalg.solve(found[d + 1 :].reshape(d, d) / pairs + PENALTY * np.eye(d), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return Ranking(mean, scale, w, _between(groups, lambda x: standard(x) @ w, int(bad), 8 * np.abs(w).sum() + 1))


def _between(groups: DataFrame, score: Callable[[np.ndarray], np.ndarray], rank: int, bound: float) -> float:
    """The middle between the scores number ``rank`` and ``rank`` + 1, all within ``bound`` of 0.

    Counts per bin narrow down where the two lie, until the bins are as narrow as their rounding.
    """
    ends = []
    for wanted in (rank, rank + 1):
        lo, hi = -bound, bound
        while hi - lo > 1e-12 * bound:
            edges = np.linspace(lo, hi, BINS + 1)
            # Scores at or below each edge.
            below = _sums(groups, lambda y, x: np.searchsorted(np.sort(score(x)), edges, side="right").astype(float))
            at = int(np.searchsorted(below, wanted))
            lo, hi = edges[max(at - 1, 0)], edges[min(at, BINS)]
        ends.append((lo + hi) / 2)
    return float(np.mean(ends))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Ranking:
    """A ranking from all labelled documents of ``labels``."""
    return fit(_grouped(docs, labels, label, doc_id, text))


def scored(
    docs: DataFrame, ranking: Ranking, text: str = "text", columns: tuple[str, ...] = ("doc_id",), score_name: str = "score"
) -> DataFrame:
    """``columns`` of ``docs`` and the score, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(ranking)
    names = [*columns, *([] if text in columns else [text])]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.scores(_inputs(batch.column(0).field(at)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["kept", "score"])

    # As one struct, columns can't clash with each other or with the score.
    kept = docs.select(F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names))).alias("kept"))
    out = kept.mapInArrow(run, f"kept {kept.schema['kept'].dataType.simpleString()}, score double")
    return out.select(*(F.col(f"kept.c{i}").alias(c) for i, c in enumerate(columns)), F.col("score").alias(score_name))


def without_low_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those below the cut; same columns."""
    columns = tuple(docs.columns)
    name = "_".join(("score", *columns))  # no column's own
    rows = scored(docs, train(docs, labels, doc_id=doc_id, text=text), text, columns, name)
    return rows.where(F.col(f"`{name}`") >= 0.5).drop(name)
