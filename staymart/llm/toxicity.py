"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: those of ``features`` (capitals, punctuation, marks inside words),
densities of words of a fixed and of a learned lexicon, of word beginnings of a learned one,
their distance to words of second person, and lexicon words written with digits for letters.

The lexicon holds terms (hashes of words in lower case and of word beginnings of 4 to 8 bytes)
that at least ``LEAST`` toxic labelled documents have, and hardly any other. Fitting sees
``bound`` labelled documents at most, in two halves by a hash of the id: each half's features
use the other half's lexicon, and the calibration sees scores of trees fitted on the other
half. Final features use the lexicon of both.

Without both labels every score is the share of label 1 (0 without labels). Null and empty
texts have features, and so a score, as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import dense
from .labelled import labelled_sample, sample_texts
from .words import Words, hashed, mix, words

BOUND = 12_000
LEAST, PURITY, TERMS = 5, 0.85, 20_000
BEGINNINGS = (4, 5, 6, 7, 8)
NEAR = 5

# Insults and words of second person in the four languages of the corpus.
INSULTS = [
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
    "dumb", "imbecile", "jerk", "filth", "garbage", "freak", "vermin",
    "dumm", "dummkopf", "abschaum", "arschloch", "versager", "widerlich", "wertlos", "blöd", "trottel",
    "imbécile", "stupide", "connard", "ordure", "minable", "débile", "crétin", "nul",
    "estúpido", "estúpida", "imbécil", "basura", "escoria", "patético", "asqueroso", "inútil", "tonto",
]
SECOND_PERSON = [
    "you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "sie",
    "tu", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "te", "ti", "tus", "usted", "ustedes", "vosotros",
]
_DIGITS = bytes.maketrans(b"013457@$", b"oieastas")
_RANDOM = np.random.Generator(np.random.PCG64(5))
_SALTS = {n: np.uint64(x) for n, x in zip(BEGINNINGS, _RANDOM.integers(1, 1 << 63, len(BEGINNINGS)), strict=True)}


def _terms(chunk: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(term hashes, the words they are of): whole words, then their beginnings."""
    yield chunk.hashes, np.arange(len(chunk.hashes))
    for n in BEGINNINGS:
        found, at = chunk.prefixes(n)
        yield mix(found ^ _SALTS[n]), at


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


_FIXED = np.sort(hashed(INSULTS))
_YOU = np.sort(hashed(SECOND_PERSON))


def lexicon_features(column: pa.Array, lexicon: np.ndarray) -> np.ndarray:
    """Densities and proximity of lexicon terms per text; ``lexicon`` is sorted."""
    out = [np.zeros((0, 9))]
    for chunk in words(column, letters=True):
        n, row, rows = np.diff(chunk.bounds), chunk.row(), chunk.rows
        learned, begun = np.zeros(len(row), bool), np.zeros(len(row), bool)
        for k, (terms, at) in enumerate(_terms(chunk)):
            hit = at[_in(terms, lexicon)]
            (begun if k else learned)[hit] = True
        fixed, you = _in(chunk.hashes, _FIXED), _in(chunk.hashes, _YOU)
        any_hit = learned | begun | fixed
        place = np.flatnonzero(you)
        near = np.zeros(len(row), bool)
        hits = np.flatnonzero(any_hit)
        if len(place) and len(hits):
            right = np.searchsorted(place, hits)
            for other in (place[np.minimum(right, len(place) - 1)], place[np.maximum(right - 1, 0)]):
                near[hits] |= (np.abs(other - hits) <= NEAR) & (row[other] == row[hits])

        def count(mask: np.ndarray, row: np.ndarray = row, rows: int = rows) -> np.ndarray:
            return np.bincount(row[mask], minlength=rows).astype(float)

        total = np.maximum(n, 1)
        found = count(any_hit)
        out.append(
            np.column_stack(
                [
                    np.log1p(count(fixed)), count(fixed) / total * 100, np.log1p(count(learned)), count(learned) / total * 100,
                    np.log1p(count(begun)), count(begun) / total * 100, np.log1p(count(near)), count(near) / np.maximum(found, 1),
                    count(you) / total,
                ]
            )
        )
    return np.concatenate(out)


def masked_insults(column: pa.Array) -> np.ndarray:
    """Fixed insults that show once digits and signs are read as letters, per text."""
    plain = np.concatenate([np.zeros(0), *(np.bincount(c.row()[_in(c.hashes, _FIXED)], minlength=c.rows) for c in words(column, letters=True))])
    column = column.fill_null("")
    _, places, data = column.buffers()
    if data is None:
        return plain[:, None]
    read = pa.Array.from_buffers(column.type, len(column), [None, places, pa.py_buffer(data.to_pybytes().translate(_DIGITS))], offset=column.offset)
    shown = np.concatenate([np.zeros(0), *(np.bincount(c.row()[_in(c.hashes, _FIXED)], minlength=c.rows) for c in words(read, letters=True))])
    return np.log1p(np.maximum(shown - plain, 0))[:, None]


def inputs(column: pa.Array, lexicon: np.ndarray) -> np.ndarray:
    return np.hstack([dense(column), masked_insults(column), lexicon_features(column, lexicon)])


@dataclass
class Trees:
    """Boosted regression trees of fixed depth on binned features, logistic loss."""

    edges: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    depth: int = 3

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, out = self.binned(x), np.full(len(x), self.start)
        every = np.arange(len(x))
        for feature, bound, value in self.splits:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[every, feature[node]] > bound[node])
            out += value[node - (2**self.depth - 1)]
        return out


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, penalty: float = 1.0
) -> Trees:
    """Newton boosting with histogram splits."""
    model = Trees(depth=depth)
    model.edges = [np.unique(np.quantile(np.unique(x[:, j]), np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model.start = float(np.log(share / (1 - share)))
    b = model.binned(x)
    f = np.full(len(x), model.start)
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        feature, bound = np.zeros(inner, int), np.full(inner, bins + 1)
        node = np.zeros(len(x), int)
        for level in range(depth):
            first = 2**level - 1
            local = node - first
            best = np.zeros(2**level)
            for j in range(x.shape[1]):
                at = local * (bins + 1) + b[:, j]
                gs, hs = (np.bincount(at, w, 2**level * (bins + 1)).reshape(-1, bins + 1).cumsum(1) for w in (g, h))
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
                gain[(hs < 0.3) | (ht - hs < 0.3)] = 0
                k = gain.argmax(1)
                top = gain[np.arange(2**level), k]
                better = top > best + 1e-9
                best[better], feature[first:][: 2**level][better], bound[first:][: 2**level][better] = top[better], j, k[better]
            node = 2 * node + 1 + (b[np.arange(len(x)), feature[node]] > bound[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + penalty)
        model.splits.append((feature, bound, value))
        f += value[leaf]
    return model


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (raw score, rate of label 1) of the best monotone fit, by pooling neighbours."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of raw, sum of y, count
    for r, v in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([r, v, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


@dataclass
class Model:
    lexicon: np.ndarray
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(column), self.knots[1][0])
        raw = self.trees.raw(inputs(column, self.lexicon))
        # A trace of the raw score keeps the order inside a calibrated block.
        return 0.998 * np.interp(raw, *self.knots) + 0.002 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _half(sample: DataFrame) -> DataFrame:
    return sample.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2)).cast("int"))


def learned_terms(sample: DataFrame) -> dict[int, np.ndarray]:
    """Lexicons by half (2: both) of a bounded sample (text, label, half)."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, half = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for chunk in words(batch.column(0), letters=True):
                row = chunk.row()
                for k, (found, at) in enumerate(_terms(chunk)):
                    _, first = np.unique(found ^ mix(row[at].astype(np.uint64)), return_index=True)
                    of = row[at][first] + chunk.first
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[first].view(np.int64)), pa.array(label[of].astype(np.int32)), pa.array(half[of].astype(np.int32))],
                        ["term", "label", "half"],
                    )

    rows = sample.select("text", "label", "half").mapInArrow(terms, "term long, label int, half int")
    n = {(h, v): F.count(F.when((F.col("half") == h) & (F.col("label") == v), 1)).alias(f"n{h}{v}") for h in (0, 1) for v in (0, 1)}
    counts = rows.groupBy("term").agg(*n.values())
    out = {}
    for which, parts in {0: (0,), 1: (1,), 2: (0, 1)}.items():
        toxic, clean = (sum((F.col(f"n{h}{v}") for h in parts), F.lit(0)) for v in (1, 0))
        good = counts.where((toxic >= LEAST) & (toxic >= PURITY * (toxic + clean)))
        top = good.orderBy(toxic.desc(), "term").select("term").limit(TERMS)
        out[which] = np.sort(np.array([r[0] for r in top.collect()], np.int64).view(np.uint64))  # TERMS at most
    return out


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", bound: int = BOUND
) -> Model:
    """A model from the labelled documents of ``labels``."""
    sample = _half(sample_texts(docs, labelled_sample(labels, label, bound, doc_id), doc_id, text))
    lexicons = learned_terms(sample)
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column(3).to_numpy()
            out = np.where((half == 0)[:, None], *(inputs(batch.column(2), shared.value[h]) for h in (1, 0)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), flat], ["doc_id", "label", "half", "x"])

    found = sample.select("doc_id", "label", "text", "half").mapInArrow(rows, "doc_id long, label int, half int, x array<double>")
    got = found.orderBy("doc_id", "x").toArrow()  # at most ``bound`` documents
    y, half = got["label"].to_numpy().astype(float), got["half"].to_numpy()
    if len(np.unique(y)) < 2:
        return Model(lexicons[2], None, (np.zeros(1), np.array([y.mean() if len(y) else 0.0])))
    x = np.array(got["x"].to_pylist(), np.float64)
    raw = np.zeros(len(y))
    for h in (0, 1):
        other = half != h
        if other.any() and (half == h).any():
            raw[half == h] = fit_trees(x[other], y[other]).raw(x[half == h])
    return Model(lexicons[2], fit_trees(x, y), isotonic(raw, y))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) per row, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(shared.value.scores(batch.column(1)))], ["doc_id", "score"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double")
