"""Repair of a conversation's structure with the cheapest edits.

A conversation's turns are to read ``(s?(ua)+)?`` by the first letters of their roles: nothing,
or user and assistant in turn, perhaps after one system turn. Faults of a turn, the first one
counting: blank (no character but space and 0x09-0x0D), duplicate (role and text seen earlier
in the conversation), truncated (its last such character is none of ``.!?``).

Edits and their costs: Keep 0; Rerole to user or assistant 3; Delete 4, which blank and
duplicate turns need; Insert an empty user or assistant turn anywhere 3. A truncated turn that
stays adds 3. The audit is the initials of the edits in order; of equally cheap audits the
least in ASCII counts.

Method. The edit lattice has a node per turn boundary and state of the pattern. An audit fixes
its way through the lattice, as each state allows one role to a rerole or insertion; and of two
equally cheap audits between the same nodes neither begins with the other, as what follows
would be insertions, which cost. So least audits are made of least parts. Two heaps, from the
first and from the last node, are emptied in order of cost and audit until their least costs
together exceed the cheapest crossing found; of all crossings that cheap the least joined
audit is taken. Conversations of more than BLOCK_TURNS are cut into blocks; each block is
searched once for every pair of states, and the cheapest blocks are joined in order.

Scale. Conversations of up to HEAVY_TURNS rows are gathered, sorted and repaired in one task
each, many per task; results by form are remembered, as forms are few. Longer ones, found by a
count, are kept apart: rows alike within a turn are folded into one with a count, duplicates
are found by a minimum per role and text, sorted rows are spread over tasks by ranges and each
task reduces its blocks to the costs and audits between states. Only these, a few letters per
turn, meet per conversation. The digest of a repaired conversation runs through its rows in
order, batch by batch. Both ways give the same rows.

Turns go by turn (nulls first), role and text. A null conv_id is a conversation of its own;
null roles and texts count as one space. Columns other than the four named are left out.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import keep

BLOCK_TURNS = 256
HEAVY_TURNS = 20_000
SPACE = " \t\n\x0b\x0c\r"
REROLE, INSERT, DELETE, CUT_SHORT = 3, 3, 4, 3
USER, ASSISTANT = "user", "assistant"
LEGAL = frozenset(("su", "ua", "au"))

# States by what came last: nothing, the system turn, a user, an assistant.
_NEXT: dict[int, dict[str, int]] = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
_ENDS = (0, 3)
_MADE = {0: 2, 1: 2, 2: 3, 3: 2}  # by a rerole or insertion
_MADE_ROLE = {0: USER, 1: USER, 2: ASSISTANT, 3: USER}
GONE = "d"

Path = tuple[int, str]
Turn = tuple[str, str]


def turn_form(role: str, text: str, duplicate: bool) -> tuple[str, str]:
    """The letter by which the lattice knows a turn, and its first fault or ''.

    s, u, a, or x for any other role, a capital if truncated; GONE for what must be deleted.
    """
    body = text.rstrip(SPACE)
    if not body:
        return GONE, "blank"
    if duplicate:
        return GONE, "duplicate"
    letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return (letter, "") if body[-1] in ".!?" else (letter.upper(), "truncated")


def _edits(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that pass a turn."""
    yield "D", DELETE, state
    if letter != GONE:
        extra = CUT_SHORT if letter.isupper() else 0
        to = _NEXT[state].get(letter.lower())
        if to is not None:
            yield "K", extra, to
        yield "R", REROLE + extra, _MADE[state]


# (initial, cost, state, next state) of every edit, by letter and by state on either side.
_PASSES = {x: [(e, c, p, q) for p in _NEXT for e, c, q in _edits(x, p)] for x in "suaxSUAX" + GONE}
_FROM = {x: [[(e, c, q) for e, c, p, q in rows if p == at] for at in _NEXT] for x, rows in _PASSES.items()}
_INTO = {x: [[(e, c, p) for e, c, p, q in rows if q == at] for at in _NEXT] for x, rows in _PASSES.items()}
_INSERTED_FROM = [[("I", INSERT, _MADE[at])] for at in _NEXT]
_INSERTED_INTO = [[("I", INSERT, p) for p in _NEXT if _MADE[p] == at] for at in _NEXT]


@lru_cache(maxsize=200_000)
def cheapest(form: str, first: int, last: int) -> Path | None:
    """(cost, audit) of the best edits of turns of these forms from one state to another."""
    n = len(form)
    # Keep alone can cost nothing and passes a turn, so by cost and turns passed a node comes
    # up only when all its equally cheap ways are known, the least audit first.
    heaps = [[(0, 0, "", first)], [(0, 0, "", last)]]
    done: tuple[dict, dict] = ({}, {})
    best: Path | None = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        side = int(heaps[1][0][0] < heaps[0][0][0])
        own, other = done[side], done[1 - side]
        cost, passed, audit, state = heapq.heappop(heaps[side])
        at = n - passed if side else passed
        if (at, state) in own:
            continue
        own[at, state] = cost, audit
        meets = [(cost, audit, other[at, state])] if (at, state) in other else []
        for moves, step in (
            ((_INTO[form[at - 1]] if side else _FROM[form[at]])[state] if (at if side else at < n) else (), 1),
            ((_INSERTED_INTO if side else _INSERTED_FROM)[state], 0),
        ):
            for initial, price, to in moves:
                node = (at - step if side else at + step, to)
                if node in own:
                    continue
                longer = initial + audit if side else audit + initial
                heapq.heappush(heaps[side], (cost + price, passed + step, longer, to))
                if node in other:
                    meets.append((cost + price, longer, other[node]))
        for here, part, (there, rest) in meets:
            whole = (here + there, rest + part if side else part + rest)
            best = whole if best is None else min(best, whole)
    return best


def blocks_of(form: str) -> list[str]:
    return [form[i : i + BLOCK_TURNS] for i in range(0, len(form), BLOCK_TURNS)] or [""]


def joined(paths: dict[int, Path], table: dict[tuple[int, int], Path]) -> dict[int, Path]:
    """The best way to each state, after a block whose ways between states are given."""
    out: dict[int, Path] = {}
    for (p, q), (cost, audit) in table.items():
        if p in paths:
            way = (paths[p][0] + cost, paths[p][1] + audit)
            out[q] = min(out.get(q, way), way)
    return out


def between_states(block: str, states: tuple[int, ...] = tuple(_NEXT)) -> dict[tuple[int, int], Path]:
    ways = {(p, q): cheapest(block, p, q) for p in states for q in _NEXT}
    return {pair: way for pair, way in ways.items() if way is not None}


def repair(form: str) -> Path:
    """(cost, audit) of a whole conversation."""
    blocks = blocks_of(form)
    if len(blocks) == 1:
        return min(filter(None, (cheapest(form, 0, q) for q in _ENDS)))
    paths: dict[int, Path] = {0: (0, "")}
    for block in blocks:
        paths = joined(paths, between_states(block, tuple(paths)))
    return min(paths[q] for q in _ENDS if q in paths)


def edited(turns: Iterator[Turn], audit: str) -> Iterator[tuple[str, str, str]]:
    """(initial of the edit, role, text) of the turns that the edits of ``audit`` leave."""
    state = 0
    for edit in audit:
        if edit == "I":
            yield edit, _MADE_ROLE[state], ""
            state = _MADE[state]
            continue
        role, text = next(turns)
        if edit == "D":
            continue
        if edit == "R":
            yield edit, _MADE_ROLE[state], text
            state = _MADE[state]
        else:
            yield edit, role, text
            state = _NEXT[state][role[:1]]


class Digest:
    """sha256 of ``role:text`` of the turns given, joined by newlines."""

    def __init__(self) -> None:
        self.sum, self.begun = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        self.sum.update((f"\n{role}:{text}" if self.begun else f"{role}:{text}").encode())
        self.begun = True

    def hex(self) -> str:
        return self.sum.hexdigest()


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTED = ("blank", "duplicate", "truncated")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _ready(turns: DataFrame, copies: str | None) -> DataFrame:
    """(conv_id, dated, turn, role, text, n): turns in their order by dated, turn, role, text."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().alias("dated"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        *[F.make_valid_utf8(F.coalesce(name, F.lit(" "))).alias(name) for name in ("role", "text")],
        (F.col(copies) if copies else F.lit(1)).cast("long").alias("n"),
    )


ORDER = ("dated", "turn", "role", "text")


def _light(rows: DataFrame) -> DataFrame:
    """The report and digest of conversations that a task can hold."""
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*ORDER, "n"))).alias("rows"))
    schema = _arrow(REPORT + ", repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, dated, turns, roles, texts, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = dict.fromkeys(_COUNTED, 0)
                said: list[Turn] = []
                form, seen = [], set()
                for role, text, n in zip(roles, texts, copies, strict=True):
                    for _ in range(n):
                        letter, fault = turn_form(role, text, (role, text) in seen)
                        seen.add((role, text))
                        form.append(letter)
                        said.append((role, text))
                        if fault:
                            counts[fault] += 1
                kept = {t for t, known, n in zip(turns, dated, copies, strict=True) if known and n}
                illegal = sum(a[0][:1] + b[0][:1] not in LEGAL for a, b in zip(said, said[1:]))
                cost, audit = repair("".join(form))
                digest = Digest()
                for _, role, text in edited(iter(said), audit):
                    digest.add(role, text)
                gaps = max(kept) - min(kept) + 1 - len(kept) if kept else 0
                out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest.hex()))
            yield _batch(out, schema)

    columns = whole.select("conv_id", *[F.col(f"rows.{name}").alias(name) for name in (*ORDER, "n")])
    return columns.select("conv_id", "dated", "turn", "role", "text", "n").mapInArrow(run, REPORT + ", repaired_sha256 string")


BLOCK = (
    "conv_id long, part long, place long, first string, last string, illegal long, blank long, duplicate long, "
    "truncated long, p int, q int, cost long, audit string"
)


def _heavy_blocks(rows: DataFrame) -> DataFrame:
    """Per block and pair of states the best edits; counts and end letters stand in each row."""
    alike = rows.groupBy("conv_id", *ORDER).agg(F.sum("n").alias("n"))
    firsts = alike.where("n > 0").groupBy("conv_id", "role", "text").agg(F.min(F.struct("dated", "turn")).alias("first"))
    seen = firsts.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    marked = alike.join(seen, same, "left").withColumn("again", F.coalesce(F.col("first") < F.struct("dated", "turn"), F.lit(False)))
    spread = marked.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    schema = _arrow(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        conv, form, first, last = None, None, "", ""
        illegal, counts, out = 0, dict.fromkeys(_COUNTED, 0), []

        def close() -> None:
            nonlocal place, form, illegal, counts
            if form is not None:
                head = (conv, part, place, first, last, illegal, *counts.values())
                out.extend((*head, p, q, *way) for (p, q), way in between_states("".join(form)).items())
                place += 1
            form, illegal, counts = None, 0, dict.fromkeys(_COUNTED, 0)

        for batch in batches:
            for key, role, text, n, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if form is not None and key != conv:
                    close()
                conv = key
                for k in range(n):
                    if form is not None and len(form) >= BLOCK_TURNS:
                        close()
                    if form is None:
                        form, first = [], role[:1]
                    else:
                        illegal += last + role[:1] not in LEGAL
                    letter, fault = turn_form(role, text, again or k > 0)
                    form.append(letter)
                    last = role[:1]
                    if fault:
                        counts[fault] += 1
            yield _batch(out, schema)
            out = []
        close()
        yield _batch(out, schema)

    return spread.select("conv_id", "role", "text", "n", "again").mapInArrow(run, BLOCK)


def _heavy_report(rows: DataFrame) -> DataFrame:
    """The report of conversations whose blocks were searched in many tasks."""
    blocks = _heavy_blocks(rows).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*[x.split()[0] for x in BLOCK.split(", ")][1:]))).alias("b"))
    names = [x.split()[0] for x in BLOCK.split(", ")][1:]
    kinds = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    schema = _arrow(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, *columns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                illegal, counts, paths, before, at = 0, [0, 0, 0], {0: (0, "")}, None, None
                table: dict[tuple[int, int], Path] = {}
                for part, place, first, last, wrong, *faults, p, q, cost, audit in zip(*columns, strict=True):
                    if (part, place) != at:
                        paths, table, at = joined(paths, table) if table else paths, {}, (part, place)
                        illegal += wrong + (before is not None and before + first not in LEGAL)
                        counts, before = [a + b for a, b in zip(counts, faults, strict=True)], last
                    table[p, q] = cost, audit
                paths = joined(paths, table)
                out.append((conv, *counts, illegal, *min(paths[q] for q in _ENDS if q in paths)))
            yield _batch(out, schema)

    report = blocks.select("conv_id", *[F.col(f"b.{n}").alias(n) for n in names]).mapInArrow(run, kinds)
    dated = F.when(F.col("dated") & (F.col("n") > 0), F.col("turn"))
    spans = rows.groupBy(F.col("conv_id").alias("c")).agg(
        (F.coalesce(F.max(dated) - F.min(dated) + 1, F.lit(0)) - F.count_distinct(dated)).alias("gaps")
    )
    whole = spans.join(report, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zero = {name: 0 for name in ("blank", "duplicate", "truncated", "illegal", "cost")}
    return whole.drop("conv_id").withColumnRenamed("c", "conv_id").fillna(zero).fillna({"audit": ""})


def _in_order(rows: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, audit, role, text, n): the audit of a conversation, then its turns in order."""
    audits = report.select("conv_id", "audit", *[F.lit(None).cast(k).alias(n) for n, k in zip((*ORDER, "n"), ("boolean", "long", "string", "string", "long"), strict=True)])
    both = audits.unionByName(rows.withColumn("audit", F.lit(None).cast("string")).select(*audits.columns))
    # Nulls go first, so an audit stands before its turns.
    placed = both.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return placed.select("conv_id", "audit", "role", "text", "n")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, Iterator[Turn]]]:
    """(conv_id, audit, turns) one after the other; turns are read as they come."""
    lines = (line for b in batches for line in zip(*(c.to_pylist() for c in b.columns), strict=True))
    head = next(lines, None)

    def turns() -> Iterator[Turn]:
        nonlocal head
        for line in lines:
            if line[1] is not None:
                head = line
                return
            for _ in range(line[4]):
                yield line[2], line[3]
        head = None

    while head is not None:
        said = turns()
        yield head[0], head[1], said
        for _ in said:  # deleted ones at the end
            pass


def _heavy_digests(rows: DataFrame, report: DataFrame) -> DataFrame:
    kinds = "conv_id long, repaired_sha256 string"
    schema = _arrow(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, audit, said in _conversations(batches):
            digest = Digest()
            for _, role, text in edited(said, audit):
                digest.add(role, text)
            yield _batch([(conv, digest.hex())], schema)

    return _in_order(rows, report).mapInArrow(run, kinds)


def repairs(turns: DataFrame, copies: str | None = None, heavy_turns: int = HEAVY_TURNS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conv_id.

    gaps are the missing numbers between a conversation's first and last turn; blank, duplicate
    and truncated count turns by their first fault; illegal counts neighbours whose role letters
    aren't su, ua or au. repaired_sha256 is of ``role:text`` of the repaired turns, joined by
    newlines. ``copies`` names a column by which a row counts several times, or with 0 not at
    all; a conversation without turns left has zeros, an empty audit and the empty digest.
    """
    rows = _ready(turns, copies)
    sizes = rows.groupBy("conv_id").agg(F.sum(F.greatest("n", F.lit(1))).alias("size"))
    heavy = keep(sizes.where(F.col("size") > heavy_turns).select(F.col("conv_id").alias("c")))
    own = F.col("conv_id").eqNullSafe(F.col("c"))
    light = _light(rows.join(heavy, own, "left_anti"))
    large = rows.join(heavy, own, "left_semi")
    report = keep(_heavy_report(large))
    digests = _heavy_digests(large, report).withColumnRenamed("conv_id", "c")
    whole = report.join(digests, own, "left").select(*light.columns)
    return light.unionByName(whole)


def repaired_turns(turns: DataFrame, report: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text) of the turns after the edits of ``report``, which
    has conv_id and audit of each conversation."""
    kinds = "conv_id long, place long, edit string, role string, text string"
    schema = _arrow(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, audit, said in _conversations(batches):
            for place, (edit, role, text) in enumerate(edited(said, audit)):
                out.append((conv, place, edit, role, text))
                if len(out) >= BLOCK_TURNS:
                    yield _batch(out, schema)
                    out = []
        yield _batch(out, schema)

    return _in_order(_ready(turns, copies), report).mapInArrow(run, kinds)
