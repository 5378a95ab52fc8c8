"""Runs of repeated words: maximal stretches of a text that repeat with a period.

A run is a stretch of words with smallest period q (words q apart are identical) and a length
of at least max(6, 4q) that no neighbouring word extends. Words are runs of bytes other than
space and 0x09-0x0D, compared exactly.

Method. A synchronising set of scale t holds positions chosen by the text around them alone:
of the t + 1 windows of t words that begin at i, ..., i + t, the one with the least hash begins
at i or at i + t. So two positions with the same 2t words after them are both chosen or both
not, and among t successive positions one is chosen. In a run of period q, t <= q < 2t, a
chosen position therefore comes again q words later within the run, and as its 2t words are
more than q, no sooner. For each scale, a power of two, successive chosen positions with equal
2t words propose their distance as a period; the stretch around them is then compared word by
word and taken if it is long enough. Windows of period t/4 or less, which lie in runs found at
lower scales, are left out of the choice, or a stretch of one repeated word would be chosen
whole; a stretch all of whose windows are left out has no period in [t, 2t). The periods
below 4 come from comparing the text with itself 1, 2 and 3 words on.

Windows are named by 64-bit hashes, built by doubling. Every run returned has been compared
word by word; a run could only be missed if two of the windows in one group of texts had the
same hash, with probability below 1e-8 for a million words.

A text of n words takes O(n log n) time and memory for a few arrays of n numbers. Texts are
looked through in groups of GROUP_BYTES, longer ones alone, and each row is independent of
all others: nothing is shuffled. Null and empty texts, and texts of white space, have no words
and no runs. Null, repeated and tied doc_ids are rows like any other. Columns not named are
left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

GROUP_BYTES = 4_000_000
LEAST_WORDS = 6
LEAST_PERIODS = 4
SMALL = 3
_OUT = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)

Change = Callable[[list[bytes], int | None], list[bytes]]
Run = tuple[int, int, int]


def _first_unlike(x: np.ndarray, at: int, d: int) -> int:
    """The first i >= at with x[i] != x[i + d]."""
    width, end = 64, len(x) - d
    while at < end:
        unlike = x[at : min(at + width, end)] != x[at + d : min(at + width, end) + d]
        if unlike.any():
            return at + int(unlike.argmax())
        at, width = at + len(unlike), width * 2
    return end


def _last_unlike(x: np.ndarray, at: int, d: int) -> int:
    """The last i < at with x[i] != x[i + d], or -1."""
    width = 64
    while at > 0:
        begin = max(0, at - width)
        unlike = x[begin:at] != x[begin + d : at + d]
        if unlike.any():
            return at - 1 - int(unlike[::-1].argmax())
        at, width = begin, width * 2
    return -1


def _small_runs(x: np.ndarray) -> list[Run]:
    """Runs of at least four periods, of the periods up to SMALL, by comparing neighbours."""
    found = []
    for q in range(1, SMALL + 1):
        same = np.flatnonzero(x[q:] == x[:-q])
        if not len(same):
            continue
        breaks = np.flatnonzero(np.diff(same) > 1)
        begins = same[np.append(0, breaks + 1)]
        lengths = same[np.append(breaks, len(same) - 1)] - begins + 1 + q
        # 2 and 3 are prime: a smaller period can only be 1.
        for a, n in zip(begins[lengths >= 4 * q].tolist(), lengths[lengths >= 4 * q].tolist(), strict=True):
            if q == 1 or x[a] != x[a + 1] or x[a] != x[a + q - 1]:
                found.append((a, n, q))
    return found


def _chosen(names: np.ndarray, t: int, runs: list[Run]) -> np.ndarray:
    """The synchronising set of scale t; ``names`` are those of the windows of t words."""
    rank = np.minimum(names, _OUT - np.uint64(1))
    for a, n, q in runs:
        if 4 * q <= t <= n:
            rank[a : a + n - t + 1] = _OUT
    least, width = rank.copy(), 1
    while width < t:
        np.minimum(least[:-width], least[width:].copy(), out=least[:-width])
        width *= 2
    least[:-1] = np.minimum(least[:-1], least[1:].copy())
    ends = least == rank
    ends[:-t] |= least[:-t] == rank[t:]
    return np.flatnonzero(ends & (least != _OUT))


def _scale_runs(x: np.ndarray, names: np.ndarray, double: np.ndarray, t: int, runs: list[Run]) -> list[Run]:
    """Runs with t <= period < 2t; ``double`` names the windows of 2t words."""
    at = _chosen(names, t, runs)
    context = double[at]
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    gap = np.diff(at)
    near = (context[1:] == context[:-1]) & (gap >= t) & (gap < 2 * t)
    begins, gaps = at[:-1][near], gap[near]
    order = np.lexsort((begins, gaps))
    begins, gaps = begins[order].tolist(), gaps[order].tolist()
    found, done, last = [], -1, 0
    for s, d in zip(begins, gaps, strict=True):
        if d == last and s < done:  # within the stretch just compared
            continue
        end = _first_unlike(x, s, d)
        begin = _last_unlike(x, s, d) + 1
        last, done = d, end
        if end > s and end + d - begin >= LEAST_PERIODS * d:
            found.append((begin, end + d - begin, d))
    return found


def find_runs(texts: list[np.ndarray]) -> list[list[Run]]:
    """(start, length, period) of the runs of each text of word numbers, by start and period.

    Numbers mean the same word in all texts and are not negative.
    """
    out: list[list[Run]] = [[] for _ in texts]
    which = np.array([i for i, words in enumerate(texts) if len(words) >= LEAST_WORDS], np.int64)
    if not len(which):
        return out
    # A number of its own after each text keeps every equality within one text.
    x = np.concatenate([part for i in which for part in (texts[i], [-1 - i])]).astype(np.int64)
    sizes = np.array([len(texts[i]) + 1 for i in which], np.int64)
    runs = _small_runs(x)
    names, t = mix(x.astype(np.uint64) * _STEP + np.uint64(1)), 1

    def tell(found: list[Run]) -> None:
        bounds = np.append(0, np.cumsum(sizes))
        for a, n, q in found:
            at = int(np.searchsorted(bounds, a, "right")) - 1
            if n >= LEAST_WORDS:
                out[which[at]].append((a - int(bounds[at]), n, q))

    def doubled(names: np.ndarray, t: int) -> np.ndarray:
        pairs = names * _STEP + np.uint64(t)
        pairs[:-t] += names[t:]
        return mix(pairs)

    tell(runs)
    while t < SMALL + 1:
        names, t = doubled(names, t), 2 * t
    while True:
        long = sizes > LEAST_PERIODS * t
        if not long.any():
            break
        if not long.all():
            # Texts that are too short for this scale go.
            kept, bounds = np.repeat(long, sizes), np.append(0, np.cumsum(sizes))
            moved = np.append(0, np.cumsum(np.where(long, sizes, 0)))
            shifted = []
            for a, n, q in runs:
                at = int(np.searchsorted(bounds, a, "right")) - 1
                if long[at]:
                    shifted.append((a - int(bounds[at]) + int(moved[at]), n, q))
            runs, x, names, which, sizes = shifted, x[kept], names[kept], which[long], sizes[long]
        double = doubled(names, t)
        found = _scale_runs(x, names, double, t, runs)
        tell(found)
        runs += found
        names, t = double, 2 * t
    return [sorted(rows) for rows in out]


def _stronger(a: Run, b: Run) -> int:
    """Order by greatest exact length / period, then start, then period."""
    more = b[1] * a[2] - a[1] * b[2]
    return more or a[0] - b[0] or a[2] - b[2]


def strongest(runs: list[Run]) -> Run | None:
    return min(runs, key=cmp_to_key(_stronger), default=None)


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words without those that some run repeats after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _rows(
    batches: Iterator[pa.RecordBatch], change: Change | None
) -> Iterator[list[tuple[int | None, list[bytes], list[Run]]]]:
    """(doc_id, words, runs) of the rows, group by group."""
    for batch in batches:
        keys, texts, start = batch.column(0).cast(pa.int64()), batch.column(1), 0
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)).cumsum()
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + GROUP_BYTES, "right")))
            group = keys[start:stop].to_pylist()
            words = [(text or b"").split() for text in texts[start:stop].to_pylist()]
            if change is not None:
                words = [change(w, key) for w, key in zip(words, group, strict=True)]
            number: dict[bytes, int] = {}
            add = number.setdefault
            ids = [np.array([add(w, len(number)) for w in row], np.int64) for row in words]
            yield list(zip(group, words, find_runs(ids), strict=True))
            start = stop


def _bytes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, period) of every run, by word number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _rows(batches, None):
            rows = [(key, *found) for key, _, spans in group for found in spans]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "period"]
            )

    return _bytes(docs, doc_id, text).mapInArrow(run, "doc_id long, start long, length long, period long")


def collapsed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of every document; what a run repeats after its first period is left out
    and the words that stay are joined by one space. A text without runs stays as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = [], []
            for group in _rows(iter([batch]), None):
                for key, words, found in group:
                    keys.append(key)
                    texts.append(b" ".join(kept_words(words, found)) if found else None)
            joined = pa.compute.coalesce(pa.array(texts, pa.binary()), batch.column(1)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), joined], ["doc_id", "text"])

    return _bytes(docs, doc_id, text).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, change: Change | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: number of runs, the one of greatest length / period, and digests.

    ``change`` replaces the words of a document before they are looked through. runs_sha256 is
    of ``start,length,period`` and a newline per run, by start and period; collapsed_sha256 of
    the words that ``kept_words`` leaves, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _rows(batches, change):
            columns: list[list] = [[] for _ in range(8)]
            for key, words, found in group:
                top = strongest(found)
                listed = "".join(f"{a},{n},{q}\n" for a, n, q in found).encode()
                row = (
                    key,
                    len(found),
                    *(top or (None, None, None)),
                    1000 * top[1] // top[2] if top else None,
                    hashlib.sha256(listed).hexdigest(),
                    hashlib.sha256(b" ".join(kept_words(words, found))).hexdigest(),
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], [n for n, _ in DIGESTS]
            )

    return _bytes(docs, doc_id, text).mapInArrow(run, ", ".join(f"{n} {kind}" for n, kind in DIGESTS))


DIGESTS = [
    ("doc_id", "long"),
    ("n_runs", "long"),
    ("start", "long"),
    ("length", "long"),
    ("period", "long"),
    ("exponent_milli", "long"),
    ("runs_sha256", "string"),
    ("collapsed_sha256", "string"),
]
