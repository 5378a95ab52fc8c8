"""Line deduplication by an exact set-similarity join.

A line's set holds its distinct words (A-Z in lower case, cut at ASCII white space). A line
goes if an earlier line, by (document id, text, line number), has a set with Jaccard
similarity of ``threshold`` or more; what happens to that earlier line doesn't matter. Lines
without a word stay. Equal sets are one class, found by a 128-bit sum; only the classes enter
the join. It orders a class's words by rarity and indexes its prefix, keeps pairs that the
length and the positional filter allow, and verifies the Jaccard similarity on the sets. A
posting also has 128 parities of its set: sets differ in as many words as these do at least.

A class needs one earlier match only, so a group of near copies isn't listed in pairs. The
postings cross the network in blocks of words; those of a word pass through a task in document
order, and each class takes from them the ``NEAREST`` earlier classes that no filter rules out,
and notes if there are more. The first are verified, then, where these fail, the others; a class
that has more is compared with all classes of the words concerned, whose postings the task hands
on. Memory in that task grows with the postings of one block of words, 56 bytes each and some
twice that to look through them, not with their pairs.

Rarity comes from counts of hashed words over all lines, in ``2**rarity_bits`` buckets; any
order gives the same result, so buckets shared by several words cost time, not pairs. A
bucket counted once holds a word no other line has, which needs no posting. A task hands on its
counts packed, a row per slice of buckets. Sets are read from a class's first line; which lines
that are is told by a bitmap of fixed size, whose chance hits an exact join drops.

Null texts count as one empty line; a null id sorts before all others. Rows that repeat both
id and text are treated alike; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rarity import RARITY_BITS, bucket_levels, packed, packed_levels
from .scratch import keep
from .words import Words, lines, mix, words

THRESHOLD = (4, 5)  # a fraction, so that limits are exact
NEAREST = 5
#: Postings looked through in one go, more if a single block has more.
AT_ONCE = 100_000
#: Blocks of words, whose postings cross the network together.
BLOCK_BITS = 15
#: Buckets of the bitmaps that tell later scans which lines to look at.
MAP_BITS = 24
_NO_ID = -(1 << 63)
_WORD = np.uint64((1 << 56) - 1)
_SPACE = " \t\n\x0b\x0c\r"
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _bucket(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _spots(ids: np.ndarray, numbers: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of lines; -1 stands for a document as a whole."""
    return _bucket(mix(ids.view(np.uint64)) + numbers.astype(np.int64).view(np.uint64), bits)


def _bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """A byte per bucket, over 0 where the bucket holds a line of ``places`` (doc_id, line) or its document."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = _ids(batch.column(0)), batch.column(1).to_numpy()
            spots = np.concatenate([_spots(ids, numbers, bits), _spots(ids, np.full(len(ids), -1), bits)])
            there = np.unique(spots).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(np.ones(len(there), np.int64))], ["bucket", "n"])

    return bucket_levels(places.mapInArrow(hashed, "bucket int, n long"), bits)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_NO_ID).to_numpy()


def _distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of each run, the run of each, and sizes; sorts in place."""
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    values, of = values[new], of[new]
    return values, of, np.bincount(of, minlength=len(bounds) - 1)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of ``sizes`` values, modulo 2**64."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _row_keys(chunk: Words) -> np.ndarray:
    """A hash of each row's whole text, with A-Z in lower case."""
    return chunk.whole().view(np.int64)


def prefix_length(sizes: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """Words of which two sets of that similarity share one at least."""
    num, den = threshold
    return np.where(sizes > 0, sizes - (sizes * num + den - 1) // den + 1, 0)


def _word_values(chunk: Words) -> np.ndarray:
    """The 56 bits that stand for each word."""
    return mix(chunk.hashes ^ _SALT) >> np.uint64(8)


def _class_of(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = mix(values & _WORD)
    return _sums(mixed, sizes), _sums(mix(mixed ^ _SALT), sizes)


def line_table(docs: DataFrame, doc_id: str, text: str, bits: int) -> DataFrame:
    """(doc_id, row_key, line, c1, c2) per line, c1 and c2 telling its set, null without words; and,
    with a null line, the task's counts of words per bucket as ``packed`` gives them."""

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        waiting, many = [], 0
        for batch in batches:
            for chunk in words(batch.column(1)):
                cut = lines(chunk)
                values = _word_values(chunk)
                waiting.append((values >> np.uint64(56 - bits)).astype(np.int64))
                many += len(values)
                if many > 1 << bits:
                    total += np.bincount(np.concatenate(waiting), minlength=1 << bits)
                    waiting, many = [], 0
                values, _, sizes = _distinct(values, cut.bounds)
                one, two = _class_of(values, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(chunk.first + cut.row)).cast(pa.int64()),
                        pa.array(_row_keys(chunk)[cut.row]),
                        pa.array(cut.number.astype(np.int32)),
                        pa.array(one.view(np.int64), mask=sizes == 0),
                        pa.array(two.view(np.int64), mask=sizes == 0),
                        *(pa.nulls(len(sizes), t) for t in (pa.int32(), pa.binary(), pa.binary())),
                    ],
                    _LINE_NAMES,
                )
        if many:
            total += np.bincount(np.concatenate(waiting), minlength=1 << bits)
        counts = packed(total)
        none = [pa.nulls(len(counts[0]), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*none, *counts], _LINE_NAMES)

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, row_key long, line int, c1 long, c2 long, slice int, places binary, counts binary"
    return kept.mapInArrow(table, schema)


_LINE_NAMES = ["doc_id", "row_key", "line", "c1", "c2", "slice", "places", "counts"]


def posting_table(docs: DataFrame, shared: Broadcast, doc_id: str, text: str, threshold: tuple[int, int]) -> DataFrame:
    """(block, postings): postings (word, c1, parity, parity2, shape, doc), in 8 bytes each, of the
    words that hash to the block. There is one per prefix word of a class, for the class's first
    document in a task; shape has the set's size over the word's place in it.

    Postings tell a class by c1 alone. Should two classes share it, both are verified.
    """
    num, den = threshold
    smallest = max(1, -(-num // (den - num)))  # two different sets below this are never similar enough

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        waiting: list[list[np.ndarray]] = []
        level = shared.value
        bits = len(level).bit_length() - 1
        for batch in batches:
            ids = _ids(batch.column(0))
            for chunk in words(batch.column(1)):
                cut = lines(chunk)
                rank = _word_values(chunk)
                rank |= level[(rank >> np.uint64(56 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
                values, of, sizes = _distinct(rank, cut.bounds)
                one, two = _class_of(values, sizes)
                starts = np.cumsum(sizes) - sizes
                place = np.arange(len(values)) - starts[of]
                limit = np.where(sizes >= smallest, prefix_length(sizes, threshold), 0)
                pick = (place < limit[of]) & (values >> np.uint64(56) > 1)
                doc = ids[chunk.first + cut.row]
                some = np.zeros(len(sizes), bool)
                some[of[pick]] = True
                asked = np.flatnonzero(some)
                earlier = [i for i, c, d in zip(asked.tolist(), one[asked].tolist(), doc[asked].tolist(), strict=True) if _earlier(seen, c, d)]
                wanted = np.zeros(len(sizes), bool)
                wanted[earlier] = True
                pick &= wanted[of]
                parities = np.zeros((2, len(sizes)), np.uint64)
                full = sizes > 0
                if full.any():
                    bit = np.uint64(1) << (values & np.uint64(63))
                    second = (values & np.uint64(64)) > 0
                    for half, words_of in enumerate((np.where(second, 0, bit), np.where(second, bit, 0))):
                        parities[half, full] = np.bitwise_xor.reduceat(words_of.astype(np.uint64), starts[full])
                at = of[pick]
                columns = [values[pick].view(np.int64), one[at].view(np.int64), *(p[at].view(np.int64) for p in parities)]
                waiting.append([*columns, sizes[at] << 32 | place[pick], doc[at]])
                if sum(len(c[0]) for c in waiting) > 4 * AT_ONCE:
                    yield listed(waiting)
                    waiting = []
        if waiting:
            yield listed(waiting)

    def listed(waiting: list[list[np.ndarray]]) -> pa.RecordBatch:
        body = np.stack([np.concatenate(p) for p in zip(*waiting, strict=True)], axis=1)
        block = _bucket(body[:, 0].copy(), BLOCK_BITS).astype(np.uint16)
        order = np.argsort(block, kind="stable")
        block, body = block[order], body[order]
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])[: len(block)])
        offsets = (np.append(starts, len(block)) * _POSTING_BYTES).astype(np.int32)
        blocks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
        return pa.RecordBatch.from_arrays([pa.array(block[starts].astype(np.int32)), blocks], ["block", "postings"])

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.mapInArrow(table, "block int, postings binary")


_POSTING_BYTES = 48


def _posting_columns(batch: pa.RecordBatch) -> np.ndarray:
    """Rows block, word, c1, parity, parity2, shape, doc of the postings of ``posting_table``."""
    blocks = batch.column(1)
    ends = np.frombuffer(blocks.buffers()[1], np.int32)[blocks.offset : blocks.offset + len(blocks) + 1]
    body = np.frombuffer(blocks.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.int64).reshape(-1, 6)
    out = np.empty((7, len(body)), np.int64)
    out[0] = np.repeat(batch.column(0).to_numpy(), np.diff(ends) // _POSTING_BYTES)
    out[1:] = body.T
    return out


def _earlier(seen: dict[int, int], value: int, doc: int) -> bool:
    """Whether the class is new in this task or in an earlier document than before."""
    if seen.get(value, doc + 1) > doc:
        seen[value] = doc
        return True
    return False


def _lists(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> pa.ListArray:
    """The runs ``rows`` of ``values`` as lists."""
    n = sizes[rows]
    ends = np.cumsum(n)
    flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[rows] - (ends - n), n)
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(values[flat].view(np.int64)))


def nearest_earlier(postings: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(word, y, x, nth): for a class y of a word's postings the nearest x in document order that
    may be similar and aren't of a later document; nth from 0, NEAREST if there may be more. Of words
    with such a y, all postings follow: (word, y, parity, parity2, shape, doc), with a null x."""
    num, den = threshold

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(_posting_columns(batch))
            last = waiting[-1][0, -1]
            if waiting[0][0, 0] == last or sum(part.shape[1] for part in waiting) < AT_ONCE:
                continue
            columns = np.concatenate(waiting, axis=1)
            # The last block may go on in the next batch.
            cut = int(np.searchsorted(columns[0], last))
            waiting = [columns[:, cut:].copy()]
            yield from found(columns[1:, :cut])
        if waiting:
            yield from found(np.concatenate(waiting, axis=1)[1:])

    def found(columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = columns[:, np.lexsort((columns[5], columns[0]))]
        word, c1, parity, parity2, shape, doc = columns
        size, place = shape >> 32, shape & 0xFFFFFFFF
        at_word, at_y, at_x, at_nth = [], [], [], []
        have = np.zeros(len(word), np.int32)

        # A pair passes the positional filter, and by that the one on lengths, if neither needs more
        # than the other has to spare.
        need = size * num
        spare = (size - place) * (num + den) - need

        def look(steps: np.ndarray, step: int) -> None:
            """From rows that have few yet, ``steps`` of each over the rows before or after it."""
            rows = np.argsort(-steps, kind="stable")
            rows = rows[(steps[rows] > 0) & (have[rows] <= NEAREST)]
            over, lag = -steps[rows], 0
            while True:
                lag += 1
                n = np.searchsorted(over, -lag, "right")
                if not n:
                    return
                rows, over = rows[:n], over[:n]
                other = rows + lag * step
                some = np.flatnonzero((spare[other] >= need[rows]) & (spare[rows] >= need[other]))
                if len(some):
                    y, x = rows[some], other[some]
                    both = size[x] + size[y]
                    apart = sum(np.bitwise_count((p[x] ^ p[y]).view(np.uint64)).astype(np.int64) for p in (parity, parity2))
                    good = (both - apart) * (num + den) >= both * num * 2
                    good &= (c1[x] != c1[y]) & (have[y] <= NEAREST)
                    y, x = y[good], x[good]
                    for column, values in ((at_word, word[y]), (at_y, c1[y]), (at_x, c1[x]), (at_nth, have[y])):
                        column.append(values)
                    have[y] += 1
                if lag % 8 == 0:
                    few = have[rows] <= NEAREST
                    rows, over = rows[few], over[few]

        at = np.arange(len(word))
        new = np.append(True, word[1:] != word[:-1])[: len(word)]
        look(at - np.maximum.accumulate(np.where(new, at, 0)), -1)
        # Lines of one document stand in no order here, so those after are looked at too.
        last = np.append(new[1:] | (doc[1:] != doc[:-1]), True)[: len(word)]
        look(np.minimum.accumulate(np.where(last, at, len(at))[::-1])[::-1] - at, 1)
        if at_word:
            out = [pa.array(np.concatenate(p)) for p in (at_word, at_y, at_x, at_nth)]
            none = [pa.nulls(len(out[0]), pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([*out, *none], _NEAR_NAMES)
        crowded = np.isin(word, word[have > NEAREST])
        if crowded.any():
            word, c1, *rest = map(pa.array, columns[:, crowded])
            none = [pa.nulls(len(word), t) for t in (pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([word, c1, *none, *rest], _NEAR_NAMES)

    ordered = postings.repartition("block").sortWithinPartitions("block")
    schema = "word long, y long, x long, nth int, parity long, parity2 long, shape long, doc long"
    return ordered.mapInArrow(stream, schema)


_NEAR_NAMES = ["word", "y", "x", "nth", "parity", "parity2", "shape", "doc"]


def class_sets(docs: DataFrame, wanted: Broadcast, doc_id: str, text: str) -> DataFrame:
    """(c1, c2, words) of the lines that a bitmap of lines has; other documents aren't cut."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = wanted.value
        bits = len(there).bit_length() - 1
        seen: dict[int, int] = {}
        for batch in batches:
            ids = _ids(batch.column(0))
            some = np.flatnonzero(there[_spots(ids, np.full(len(ids), -1), bits)])
            parts = pc.split_pattern(batch.column(1).take(pa.array(some)).fill_null(""), "\n")
            many = pc.list_value_length(parts).to_numpy().astype(np.int64)
            number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            pick = np.flatnonzero(there[_spots(np.repeat(ids[some], many), number, bits)])
            for chunk in words(parts.flatten().take(pa.array(pick))):
                values, _, sizes = _distinct(_word_values(chunk), chunk.bounds)
                one, two = _class_of(values, sizes)
                rows = np.flatnonzero(sizes)
                rows = np.array([i for i, c in zip(rows.tolist(), one[rows].tolist(), strict=True) if _earlier(seen, c, 0)], np.int64)
                starts = np.cumsum(sizes) - sizes
                for part in range(0, len(rows), 10_000):
                    r = rows[part : part + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one[r].view(np.int64)), pa.array(two[r].view(np.int64)), _lists(values, starts, sizes, r)],
                        ["c1", "c2", "words"],
                    )

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.mapInArrow(sets, "c1 long, c2 long, words array<long>")


def _similar(a: str, b: str, threshold: tuple[int, int]) -> Column:
    num, den = threshold
    common = F.size(F.array_intersect(a, b))
    return common * den >= (F.size(a) + F.size(b) - common) * num


def repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: tuple[int, int] = THRESHOLD,
    rarity_bits: int = RARITY_BITS,
    map_bits: int = MAP_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_key, line) of every line, and of those that go."""
    num, den = threshold
    share = docs.sparkSession.sparkContext.broadcast
    table = keep(line_table(docs, doc_id, text, rarity_bits))
    every = table.where("line IS NOT NULL").select("doc_id", "row_key", "line", "c1", "c2")
    counts = table.where("slice IS NOT NULL").select("slice", "places", "counts")
    levels = share(packed_levels(counts, rarity_bits))
    at = F.struct("doc_id", "row_key", "line")
    classes = keep(every.where("c1 IS NOT NULL").groupBy("c1", "c2").agg(F.min(at).alias("first"), F.count("*").alias("n")))

    near = keep(nearest_earlier(posting_table(docs, levels, doc_id, text, threshold), threshold))
    pairs = keep(near.where("x IS NOT NULL").groupBy("x", "y").agg(F.min("nth").alias("nth")))

    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(*(F.col(c).alias(name if c == "c1" else f"{name}_{c}") for c in frame.columns))

    def sets_of(pairs: DataFrame) -> DataFrame:
        """(c1, c2, first, words) of the classes of ``pairs``; a set is read from the class's first line."""
        asked = pairs.select(F.explode(F.array("x", "y")).alias("c1")).distinct()
        names = keep(classes.select("c1", "c2", "first").join(asked, "c1", "left_semi"))
        wanted = share(_bitmap(names.select("first.doc_id", "first.line"), map_bits))
        sets = class_sets(docs, wanted, doc_id, text).dropDuplicates(["c1", "c2"])
        return keep(names.join(sets, ["c1", "c2"]))

    def later(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        both = pairs.join(side(sets, "x"), "x").join(side(sets, "y"), "y")
        return keep(_later(both.where(_similar("x_words", "y_words", threshold))))

    # Of the nearest that its words give a class two are tried first.
    sets = sets_of(pairs)
    tried = pairs.where("nth = 0").groupBy("y").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    tried = keep(tried.select("y", F.explode(F.array_distinct(F.array("a", "b"))).alias("x")))
    matched = later(tried, sets)

    def unmatched(frame: DataFrame) -> DataFrame:
        return frame.join(matched.select(F.col("c1").alias("y")).distinct(), "y", "left_anti")

    others = keep(unmatched(pairs).select("x", "y").join(tried, ["x", "y"], "left_anti"))
    matched = keep(matched.union(later(others, sets)).distinct())
    tried = tried.union(others)

    # Classes that may have more candidates at a word, of which none held so far.
    left = keep(unmatched(near.where(F.col("nth") == NEAREST)).select("word", "y").distinct())
    of_word = near.where("x IS NULL").select("word", F.col("y").alias("c1"), "parity", "parity2", "shape", "doc")
    of_word = of_word.join(left.select("word").distinct(), "word", "left_semi")
    numbers = ("parity", "parity2", "shape")
    of_word = of_word.groupBy("word", "c1").agg(*(F.first(c).alias(c) for c in numbers), F.min("doc").alias("doc"))
    place = F.col("shape").bitwiseAND(0xFFFFFFFF)
    of_word = keep(of_word.withColumns({"size": F.shiftright("shape", 32), "place": place}).drop("shape"))
    y = side(of_word, "y").join(left.select(F.col("word").alias("y_word"), "y"), ["y_word", "y"], "left_semi")
    x = side(of_word, "x")
    both = F.col("x_size") + F.col("y_size")
    length = F.least("x_size", "y_size") * den >= F.greatest("x_size", "y_size") * num
    # What two sets can share from their first common word on must reach the overlap needed.
    rest = F.least(F.col("x_size") - F.col("x_place"), F.col("y_size") - F.col("y_place"))
    position = rest * (num + den) >= both * num
    apart = sum(
        (F.bit_count(F.col(f"x_{p}").bitwiseXOR(F.col(f"y_{p}"))) for p in ("parity", "parity2")), F.lit(0)
    )
    parity = (both - apart) * (num + den) >= both * num * 2
    filters = (F.col("x") != F.col("y")) & (F.col("x_doc") <= F.col("y_doc")) & length & position & parity
    more = y.join(x, (F.col("x_word") == F.col("y_word")) & filters).select("x", "y").distinct()
    # What was tried before needs no second look.
    more = keep(more.join(tried, ["x", "y"], "left_anti"))
    matched = matched.union(later(more, sets_of(more)))

    first = [F.col(f"first.{c}").alias(f"first_{c}") for c in ("doc_id", "row_key", "line")]
    known = classes.where("n > 1").select("c1", "c2", *first, F.lit(False).alias("matched"))
    known = known.union(matched.select("c1", "c2", *first, F.lit(True)))
    # All rows of a class name the same first line.
    known = known.groupBy("c1", "c2").agg(*(F.max(c).alias(c) for c in known.columns[2:]))
    after = F.struct("first_doc_id", "first_row_key", "first_line") < at
    # Few classes are known: their side is hashed, so that the lines needn't be sorted.
    gone = every.join(known.hint("shuffle_hash"), ["c1", "c2"]).where(F.col("matched") | after)
    return tuple(frame.select("doc_id", "row_key", "line") for frame in (every, gone))


def _later(linked: DataFrame) -> DataFrame:
    """(c1, c2, first) of the later class of each linked pair."""
    x_later = F.col("x_first") > F.col("y_first")
    return linked.select(
        F.when(x_later, F.col("x")).otherwise(F.col("y")).alias("c1"),
        *(F.when(x_later, F.col(f"x_{c}")).otherwise(F.col(f"y_{c}")).alias(c) for c in ("c2", "first")),
    ).distinct()


def _numbers(gone: DataFrame) -> DataFrame:
    """(doc_id, row_key, gone): the sorted numbers of a document's lines that go, if any do."""
    return gone.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: n_lines, n_removed and the removed line numbers, joined by commas."""
    every, gone = repeated_lines(docs, **options)
    # A document has all lines up to its last, however often its row comes.
    rows = every.groupBy("doc_id", "row_key").agg((F.max("line") + 1).cast("long").alias("n_lines"))
    gone = _numbers(gone).select(F.col("doc_id").alias("g_id"), F.col("row_key").alias("g_key"), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("row_key") == F.col("g_key"))
    numbers = F.coalesce("gone", F.array().cast("array<int>"))
    return rows.join(gone, same, "left").select(
        "doc_id",
        "n_lines",
        F.size(numbers).cast("long").alias("n_removed"),
        F.array_join(numbers, ",").alias("removed_lines"),
    )


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the repeated lines; same columns.

    A document that had words and has none left goes.
    """
    _, gone = repeated_lines(docs, doc_id, text, **options)
    gone = _numbers(gone).groupBy("doc_id").agg(F.collect_list(F.struct("row_key", "gone")).alias("found"))
    wanted = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    d = docs.select(wanted.alias("doc"), F.col(doc_id).alias("d_id"))
    place = docs.columns.index(text)
    joined = d.join(gone, F.col("d_id").eqNullSafe(F.col("doc_id")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).field(place)
            texts, asked = column.to_pylist(), batch.column(1).to_pylist()
            stays = np.ones(batch.num_rows, bool)
            for chunk in words(column):
                keys = _row_keys(chunk)
                for r in range(chunk.rows):
                    for group in asked[chunk.first + r] or ():
                        if group["row_key"] == keys[r]:
                            drop = set(group["gone"])
                            parts = texts[chunk.first + r].split("\n")
                            texts[chunk.first + r] = "\n".join(x for i, x in enumerate(parts) if i not in drop)
                            stays[chunk.first + r] = bool(texts[chunk.first + r].strip(_SPACE))
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc", "text"])
            yield out.filter(pa.array(stays))

    doc_type = joined.select("doc").schema["doc"].dataType.simpleString()
    rows = joined.select("doc", "found").mapInArrow(cut, f"doc {doc_type}, text string")
    return rows.select(
        *(F.col("text").alias(c) if c == text else F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns))
    )
