"""Hashes of the words of a whole Arrow column of texts, without a Python object per word.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z in lower case. Its hash is
a polynomial of its bytes at a random odd number modulo 2**64, read off running sums, then mixed; that of
a chance collision between two words is near 2**-58.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
MAX_ROWS = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BASE = int(_RANDOM.integers(0, 1 << 62, dtype=np.uint64)) * 8 + 5
_NEWLINE = 10


def _no_space(text: np.ndarray) -> np.ndarray:
    return (text != 32) & ((text - np.uint8(9)) > 4)


def _letters(text: np.ndarray) -> np.ndarray:
    """Letters; every byte of a non-ASCII character counts as one."""
    return (text >= 128) | (((text | np.uint8(32)) - np.uint8(97)) < 26)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % (1 << 64), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _TABLES or len(_TABLES["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _TABLES["up"] = _powers(_BASE, size)
        _TABLES["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _TABLES["up"], _TABLES["down"]


@dataclass
class Words:
    """The words of rows ``first`` to ``first + rows`` of the column, in order.

    ``bounds[r]:bounds[r + 1]`` are the words of row r of the chunk.
    """

    first: int
    rows: int
    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    text: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    sums: np.ndarray

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))

    def whole(self) -> np.ndarray:
        """A hash of each row with all its bytes, spaces included."""
        _, down = _tables(len(self.text) + 1)
        return mix((self.sums[self.offsets[1:]] - self.sums[self.offsets[:-1]]) * down[self.offsets[:-1]])

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``n`` bytes of the words that long, and where those words are."""
        at = np.flatnonzero(self.lengths >= n)
        starts = self.starts[at]
        _, down = _tables(len(self.text) + 1)
        return mix((self.sums[starts + n] - self.sums[starts]) * down[starts]), at


def words(column: pa.Array, chunk_bytes: int = CHUNK_BYTES, letters: bool = False) -> Iterator[Words]:
    """Chunks of whole rows of about ``chunk_bytes``; a longer row is a chunk of its own.

    A null text has no words. With ``letters`` a word is a run of letters.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, "right")) - 1
        last = min(n, first + MAX_ROWS, max(last, first + 1))
        yield _chunk(data[offsets[first] : offsets[last]], offsets[first : last + 1], first, _letters if letters else _no_space)
        first = last


def _chunk(text: np.ndarray, offsets: np.ndarray, first: int, inside: Callable[[np.ndarray], np.ndarray]) -> Words:
    offsets = offsets - offsets[0]
    rows, n = len(offsets) - 1, len(text)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(first, rows, none.astype(np.uint64), np.zeros(rows + 1, np.int64), none, text, offsets, none, np.zeros(1, np.uint64))
    solid = inside(text)
    turns = np.flatnonzero(solid[1:] != solid[:-1]) + 1  # where words begin and end, in turn
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < n)]
    # A row that ends in a word before one that begins with one: the word ends, another begins.
    joined = edges[solid[edges - 1] & solid[edges]]
    turns = np.insert(turns, np.repeat(np.searchsorted(turns, joined), 2), np.repeat(joined, 2))
    turns = np.concatenate([[0] * bool(solid[0]), turns, [n] * bool(solid[-1])]).astype(np.int64)
    starts, stops = turns[0::2], turns[1::2]
    up, down = _tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    capital = (text - np.uint8(65)) < 26
    weighted = (text + (capital.view(np.uint8) << np.uint8(5))).astype(np.uint64)
    weighted += np.uint64(257)
    weighted *= up[:n]
    np.cumsum(weighted, out=sums[1:])
    hashes = mix((sums[stops] - sums[starts]) * down[starts])
    bounds = np.searchsorted(starts, offsets)
    return Words(first, rows, hashes, bounds, starts, text, offsets, stops - starts, sums)


def hashed(terms: list[str]) -> np.ndarray:
    """Hashes of whole words, as ``words`` gives them."""
    return np.concatenate([c.hashes for c in words(pa.array(terms, pa.string()), letters=True)])


@dataclass
class Lines:
    """Lines of a chunk: row of the chunk, number in its row, and word bounds per line."""

    row: np.ndarray
    number: np.ndarray
    bounds: np.ndarray


def lines(chunk: Words) -> Lines:
    """Rows cut at newlines; every row has a line at least, and words keep their order."""
    breaks = np.flatnonzero(chunk.text == _NEWLINE)
    inside = np.searchsorted(chunk.offsets, breaks, "right") - 1
    at = np.concatenate([chunk.offsets[:-1], breaks + 1])
    row = np.concatenate([np.arange(chunk.rows), inside])
    order = np.lexsort((at, row))
    at, row = at[order], row[order]
    number = np.arange(len(row)) - np.searchsorted(row, np.arange(chunk.rows))[row]
    bounds = np.append(np.searchsorted(chunk.starts, at), len(chunk.starts))
    return Lines(row, number, bounds)
