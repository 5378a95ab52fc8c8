"""Plain-Python versions of the operators, and small frames to run them on."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import regex
from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS)


def byte_words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^ \t-\r]+", (text or "").encode().lower())


def shingle_set(text: str | None, n: int) -> frozenset:
    w = byte_words(text)
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_components(texts: list[tuple[int, str | None]], n: int = 4, percent: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component)."""
    sets = {i: shingle_set(t, n) for i, t in texts}
    parent = {i: i for i in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeated(texts: list[tuple[int, str | None]]) -> dict[int, list[int]]:
    """doc_id -> numbers of lines that repeat an earlier one."""
    lines = [
        (i, k, frozenset(byte_words(line)))
        for i, t in sorted(texts)
        for k, line in enumerate((t or "").split("\n"))
    ]
    out: dict[int, list[int]] = defaultdict(list)
    for at, (i, k, w) in enumerate(lines):
        if w and any(x and 5 * len(w & x) >= 4 * len(w | x) for _, _, x in lines[:at]):
            out[i].append(k)
    return dict(out)


def item_words(text: str | None) -> list[str]:
    return [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", (text or "").lower()) if w]


def weighted(words: list[str], n: int = 5) -> Counter:
    n = min(n, len(words))
    out: Counter = Counter()
    for i in range(len(words) - n + 1 if n else 0):
        out[tuple(words[i : i + n])] += sum(map(len, words[i : i + n]))
    return out


def held_items(texts: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> dict[tuple[int, int], float]:
    out = {}
    for d, text in texts:
        w = item_words(text)
        for i, item in items:
            x = item_words(item)
            want = weighted(x)
            n = min(5, len(x))
            places = defaultdict(list)
            for q in range(len(x) - n + 1 if n else 0):
                places[tuple(x[q : q + n])].append(q)
            # Windows stand where a shingle of the item meets the same one in the text.
            starts = {
                max(0, min(p - q, len(w) - len(x)))
                for p in range(len(w) - n + 1 if n else 0)
                for q in places.get(tuple(w[p : p + n]), ())
            }
            for at in starts:
                got: Counter = Counter()
                part = w[at : at + len(x)]
                for k in range(len(part) - n + 1 if n else 0):
                    got[tuple(part[k : k + n])] += sum(map(len, part[k : k + n]))
                both, either = sum((got & want).values()), sum((got | want).values())
                if either and both * 100 >= either * 80:
                    out[d, i] = max(out.get((d, i), 0), both / either)
    return out
