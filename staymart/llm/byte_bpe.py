"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A vocabulary is a file of ranks: token bytes in base64 and their rank, which is their id. Each
byte is written as one character, so that the library merges bytes. Of every token the last
merge that makes it alone is worked out; whatever stands around a token, its bytes were merged
in that order, as no earlier merge crossed its ends. One merge per token, in the order of the
ranks, therefore gives the ids that merging by rank gives. A piece that is itself a token is
taken whole.

A text is cut into the matches of a pattern, its pieces; what no match covers is left out.
Each task keeps a table of the pieces that it has met and has the library encode a new one
once. A full table is dropped and begun anew and long pieces are never stored, so memory is
bounded; results don't depend on either.

Decoding reverses the byte table. A token may hold a part of a character only: its offsets
cover that character, and ``Decoder`` gives the character with the token that completes it.
Bytes that are no text become U+FFFD.

Null texts are empty: no ids, decoded to nothing. Invalid bytes in a text count as U+FFFD.
Null and repeated doc_ids pass through, row by row; columns not named are left out. Whole
texts are encoded whatever their length.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

TABLE_PIECES = 500_000
STORED_CHARS = 64
GROUP_CHARS = 1_000_000
SLICE_ROWS = 1024
_NONE = 1 << 60


def byte_characters() -> list[str]:
    """The character of each byte: printable Latin-1 ones stand for themselves."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"{len(missing)} bytes have no rank")
    return ranks


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that merging by rank leaves before the whole token; None: never made."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, _NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == _NONE:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def library_tokenizer(ranks: dict[bytes, int]) -> Tokenizer:
    """The library's tokenizer for single pieces, each byte written as its character."""
    names = byte_characters()

    def name(token: bytes) -> str:
        return "".join(names[b] for b in token)

    made = (last_merge(t, ranks) for t in sorted(ranks, key=ranks.get) if len(t) > 1)
    merges = [(name(a), name(b)) for a, b in filter(None, made)]
    vocabulary = {name(token): rank for token, rank in ranks.items()}
    # The library's own cache would be a second table of pieces.
    return Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True, cache_capacity=0))


class Encoder:
    """Texts to ids, as little-endian 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pieces: int = TABLE_PIECES):
        # The tokenizer owns its model, so it is kept too.
        self.tokenizer, self.pieces = library_tokenizer(ranks), pieces
        self.model = self.tokenizer.model
        self.cut, self.known = regex.compile(pattern), {}
        if self.cut.groups:
            raise ValueError("groups of the pattern must not capture")
        self.names = dict(enumerate(byte_characters()))

    def _library(self, piece: str) -> bytes:
        written = piece.encode().decode("latin-1").translate(self.names)
        ids = array("I", [t.id for t in self.model.tokenize(written)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for group in _groups(texts):
            cut = [self.cut.findall(text) for text in group]
            if len(self.known) > self.pieces:
                self.known.clear()
            known, long = self.known, {}
            for piece in {*chain.from_iterable(cut)}.difference(known):
                (known if len(piece) <= STORED_CHARS else long)[piece] = self._library(piece)
            for pieces in cut:
                yield b"".join([known.get(p) or long[p] for p in pieces] if long else [known[p] for p in pieces])


def _groups(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Runs of texts of GROUP_CHARS or a little more."""
    group, chars = [], 0
    for text in texts:
        group.append(text or "")
        chars += len(group[-1])
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


class Decoder:
    """Ids to bytes, to text and to the text that each token completes."""

    def __init__(self, ranks: dict[bytes, int]):
        names = byte_characters()
        byte_of = {c: b for b, c in enumerate(names)}
        written = {rank: "".join(names[b] for b in token) for token, rank in ranks.items()}
        self.tokens: list[bytes | None] = [None] * (max(written) + 1)
        for rank, text in written.items():
            self.tokens[rank] = bytes(byte_of[c] for c in text)
        self.sizes = np.array([len(t or b"") for t in self.tokens], np.int64)

    def to_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def to_text(self, ids: Iterable[int]) -> str:
        return self.to_bytes(ids).decode("utf-8", "replace")

    def pieces(self, ids: Iterable[int]) -> list[str]:
        """The text that each token completes; the last one also ends what stays incomplete."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        out = [state.decode(self.tokens[i]) for i in ids]
        if out:
            out[-1] += state.decode(b"", True)
        return out

    def offsets(self, ids: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First code point of each token and the one after its last, in valid UTF-8 ``text``."""
        ends = np.cumsum(self.sizes[ids])
        begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        character = np.cumsum(begins) - 1
        return character[ends - self.sizes[ids]], character[ends - 1] + 1


@lru_cache(maxsize=2)
def _tools(rank_file: str, pattern: str) -> tuple[Encoder, Decoder]:
    """One of each per Python worker: reading the ranks takes longer than many a task."""
    ranks = read_ranks(rank_file)
    return Encoder(ranks, pattern), Decoder(ranks)


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.make_valid_utf8(F.col(text)).alias("text"))


def _slices(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield part.column(0).cast(pa.int64()), list(encoder.encode(part.column(1).to_pylist()))


def encoded(docs: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, starts, ends, decoded) per row; starts and ends are code points of the
    matched text, which is the decoded one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(rank_file, pattern)
        for keys, rows in _slices(batches, encoder):
            ids = [np.frombuffer(row, "<u4").astype(np.int32) for row in rows]
            back = [decoder.to_bytes(row.tolist()) for row in ids]
            places = [decoder.offsets(row, whole) for row, whole in zip(ids, back, strict=True)]
            bounds = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())

            def lists(parts: list[np.ndarray], bounds: pa.Array = bounds) -> pa.Array:
                return pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(parts).astype(np.int32)))

            decoded = pa.array([whole.decode("utf-8", "replace") for whole in back], pa.string())
            yield pa.RecordBatch.from_arrays(
                [keys, lists(ids), lists([s for s, _ in places]), lists([e for _, e in places]), decoded],
                ["doc_id", "ids", "starts", "ends", "decoded"],
            )

    shape = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string"
    return _texts(docs, doc_id, text).mapInArrow(run, shape)


def digests(docs: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row, from the same encoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(rank_file, pattern)
        for keys, rows in _slices(batches, encoder):
            back = (decoder.to_bytes(np.frombuffer(row, "<u4").tolist()) for row in rows)
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(row) // 4 for row in rows], pa.int64()),
                    pa.array([hashlib.sha256(row).hexdigest() for row in rows], pa.string()),
                    pa.array([hashlib.sha256(whole).hexdigest() for whole in back], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _texts(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
