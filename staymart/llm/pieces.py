"""SentencePiece encoding and decoding with a table of distinct chunks.

For a model none of whose pieces has a white-space marker after another character, no merge
crosses from a character into a following marker. A text may then be cut into chunks, a run
of markers and the characters after it, and encoded chunk by chunk. Each task keeps a table
of the distinct chunks it has met, segments each of them once with the library and joins the
ids and the decoded text back by position. A full table is dropped and begun anew, and long
chunks are never stored, so memory is bounded; results don't depend on either.

Null texts are empty: the end id alone, decoded to nothing. Whole texts are encoded whatever
their length. Other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
TABLE_CHUNKS = 150_000
STORED_CHARS = 64
GROUP_CHARS = 500_000
_CHUNKS = re.compile(" +[^ ]*|[^ ]+")


def pieces_keep_markers_first(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether chunks may be encoded apart."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return all(MARKER not in p.lstrip(MARKER) for p in pieces)


class ChunkTable:
    """Chunk -> (ids as decimal text, their number, decoded text)."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor, chunks: int = TABLE_CHUNKS):
        if not pieces_keep_markers_first(model):
            raise ValueError("a piece of this model goes on after a white-space marker")
        self.model, self.chunks, self.known = model, chunks, {}
        self.marker = [model.piece_to_id(MARKER)]
        # Ids that decode to a character: what follows them keeps its leading space.
        self.anchor = model.piece_to_id("a")
        if model.decode([self.anchor]) != "a":
            raise ValueError("the model has no piece for the letter a alone")

    def _segment(self, chunks: list[str]) -> list[tuple[str, int, str]]:
        # The library puts a marker before the text, so the chunk's first one is left to it.
        found = self.model.encode([c[1:] for c in chunks], num_threads=1)
        # It puts none before an empty text.
        found = [ids or self.marker for ids in found]
        texts = self.model.decode([[self.anchor, *ids] for ids in found])
        return [(" ".join(map(str, ids)), len(ids), t[1:]) for ids, t in zip(found, texts, strict=True)]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, int, str]]:
        """(ids joined by one space, their number, decoded text) of each text."""
        for group in _groups(texts):
            cut = [split(t) if t else [] for t in group]
            known, extra = self.known, {}
            if len(known) > self.chunks:
                known.clear()
            fresh = [c for c in dict.fromkeys(chain.from_iterable(cut)) if c not in known]
            if fresh:
                for c, found in zip(fresh, self._segment(fresh), strict=True):
                    (known if len(c) <= STORED_CHARS else extra)[c] = found
            for chunks in cut:
                if not chunks:
                    yield "", 0, ""
                    continue
                rows = [known.get(c) or extra[c] for c in chunks] if extra else [known[c] for c in chunks]
                ids, counts, decoded = zip(*rows, strict=True)
                # The space that the library puts before a text is not part of it.
                yield " ".join(ids), sum(counts), "".join(decoded)[1:]


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of GROUP_CHARS or a little more; a longer text is a run of its own."""
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text or "")
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def split(text: str) -> list[str]:
    """Chunks that each begin with a space (a marker counts as one)."""
    text = text.replace(MARKER, " ")
    if "  " in text or text[-1] == " " or text[0] == " ":
        return _CHUNKS.findall(" " + text)
    return [" " + w for w in text.split(" ")]


def encoded(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int> with the end id, decoded) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        table, end = ChunkTable(model), model.eos_id()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                ids, ends, decoded = [], [0], []
                for joined, n, back in table.encode(part.column(1).to_pylist()):
                    ids.append(np.fromstring(f"{joined} {end}", np.int32, sep=" "))
                    ends.append(ends[-1] + n + 1)
                    decoded.append(back)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"]
                )

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row, from the same encoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        table, end = ChunkTable(model), str(model.eos_id())
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                counts, of_ids, of_text = [], [], []
                for joined, n, back in table.encode(part.column(1).to_pylist()):
                    counts.append(n + 1)
                    line = f"{joined} {end}" if joined else end
                    of_ids.append(hashlib.sha256(line.encode()).hexdigest())
                    of_text.append(hashlib.sha256(back.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
