"""Dense numeric features of whole texts, from bytes and word hashes.

A text without words has finite features too: every rate is then zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import lines, mix, words

_GROUPS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "\n", ".,;:", "!", "?", "*", "#", "%", "$", "&", "|", "-_", "'\"()[]{}<>", "@/\\+=~^`")
NAMES = (
    "upper", "digit", "newline", "stops", "exclaim", "question", "star", "hash", "percent", "dollar",
    "ampersand", "bar", "dashes", "brackets", "other_marks", "non_ascii", "control",
)
WORD_NAMES = (
    "log_words", "distinct_words", "distinct_pairs", "repeated_next", "word_length", "capitalised",
    "short_words", "words_per_line", "distinct_lines", "mark_runs", "inner_marks",
)
_PLAIN, _HIGH, _TAIL, _CONTROL = len(_GROUPS) + 2, len(_GROUPS), len(_GROUPS) + 3, len(_GROUPS) + 1


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _PLAIN)
    kind[:32] = _CONTROL
    kind[127] = _CONTROL
    kind[9] = kind[13] = _PLAIN
    for k, group in enumerate(_GROUPS):
        kind[[ord(c) for c in group]] = k
    kind[192:] = _HIGH
    kind[128:192] = _TAIL  # the rest of a character that began before
    return kind


_KIND = _byte_classes()
_KINDS = _TAIL + 1
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,-'" for b in range(256)])
_OBFUSCATES = _MARK | np.isin(np.arange(256), [ord(c) for c in "0134579"])


def _rate(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    return x / np.maximum(of, 1)


def _distinct_rate(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    # One sortable number per value: 20 bits of the row, 44 of the hash.
    key = np.sort((row.astype(np.uint64) << np.uint64(44)) | (values >> np.uint64(20)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=rows)
    return _rate(distinct, np.bincount(row, minlength=rows))


def dense(column: pa.Array) -> np.ndarray:
    """A row of NAMES and WORD_NAMES per text."""
    out = [np.zeros((0, len(NAMES) + len(WORD_NAMES)))]
    for chunk in words(column):
        rows = chunk.rows
        of = np.repeat(np.arange(rows), np.diff(chunk.offsets))
        counts = np.bincount(of * _KINDS + _KIND[chunk.text], minlength=rows * _KINDS).reshape(rows, _KINDS)
        chars = counts.sum(1) - counts[:, _TAIL]
        shares = counts[:, : len(NAMES)] / np.maximum(chars, 1)[:, None]

        row, n = chunk.row(), np.diff(chunk.bounds)
        h = chunk.hashes
        inside = row[1:] == row[:-1]
        pair = mix(h[1:] ^ mix(h[:-1]))[inside]
        cut = lines(chunk)
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h), out=sums[1:])
        sizes = np.diff(cut.bounds)
        full = sizes > 0
        line_hash = (sums[cut.bounds[1:]] - sums[cut.bounds[:-1]])[full]
        n_lines = np.bincount(cut.row[full], minlength=rows)
        t = chunk.text
        marks, letters, odd = _MARK[t], _LETTER[t], _OBFUSCATES[t]
        runs, inner = np.zeros(len(t), bool), np.zeros(len(t), bool)
        runs[1:] = marks[1:] & marks[:-1]
        inner[1:-1] = letters[:-2] & odd[1:-1] & letters[2:]
        first = t[chunk.starts]
        features = [
            np.log1p(n),
            _distinct_rate(h, row, rows),
            _distinct_rate(pair, row[1:][inside], rows),
            _rate(np.bincount(row[1:][inside & (h[1:] == h[:-1])], minlength=rows), n),
            _rate(np.bincount(row, chunk.lengths, rows), n) / 10,
            _rate(np.bincount(row[(first >= 65) & (first <= 90)], minlength=rows), n),
            _rate(np.bincount(row[chunk.lengths <= 3], minlength=rows), n),
            np.log1p(_rate(n, n_lines)),
            _distinct_rate(line_hash, cut.row[full], rows),
            _rate(np.bincount(of[runs], minlength=rows), n),
            _rate(np.bincount(of[inner], minlength=rows), n),
        ]
        out.append(np.column_stack([shares, *features]))
    return np.concatenate(out)
