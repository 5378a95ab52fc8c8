"""Runs, byte-level BPE and conversation repair against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staymart.llm import byte_bpe, periodic_runs, turn_repair
from staymart.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD_TEXTS = [
    (1, "a b c " * 5), (1, "a b c " * 5), (None, "x x x x x x x"), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "),
    (5, "x" * 5), (6, "ü\xa0ü ü\xa0ü " * 3), (7, "a A a A a A a A"), (8, "w " * 200_000), (9, "one two\x00three 漢字 🙂 ́ ﷺ"),
    (10, "p q r s " * 3 + "p q r s t " * 4), (11, "Y" * 100_000), (-7, "z z z z z"),
]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every maximal stretch by comparing each word with the one q words on, for each q."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(
                all(words[k] == words[k + p] for k in range(i, j + q - p)) for p in range(1, q)
            ):
                found.append((i, length, q))
            i = j + 1
    return sorted(found)


def plain_digest(doc_id, text, planted: bool):
    words = (text or "").encode().split()
    n = len(words)
    if planted and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    return (
        doc_id, len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
        sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(kept)),
    )


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 6)), max_size=5), max_size=6))
def test_runs_of_any_words(texts):
    rows = [[w for part, times in text for w in part * times] for text in texts]
    got = periodic_runs.find_runs([np.array(r, np.int64) for r in rows])
    assert got == [plain_runs(r) for r in rows]


def test_runs_within_runs():
    inner = ([1] * 6 + [2]) * 5 + [3]
    words = inner * 4 + [4] + list(range(5, 300)) * 5
    assert periodic_runs.find_runs([np.array(words, np.int64)]) == [plain_runs(words)]


def test_run_digests(spark):
    texts = [t for t in ODD_TEXTS if t[0] != 8]
    got = periodic_runs.digests(frame(spark, texts)).collect()
    assert ordered(got) == ordered([plain_digest(i, t, False) for i, t in texts])
    long = periodic_runs.digests(frame(spark, [t for t in ODD_TEXTS if t[0] == 8])).first()
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 200_000, 1)
    assert long.collapsed_sha256 == sha(b"w")
    assert periodic_runs.digests(frame(spark, [])).count() == 0


def test_runs_and_collapsed(spark):
    docs = frame(spark, ODD_TEXTS)
    rows = periodic_runs.runs(docs).collect()
    want = [(i, *r) for i, t in ODD_TEXTS if i != 8 for r in plain_runs((t or "").encode().split())]
    assert ordered(rows) == ordered([*want, (8, 0, 200_000, 1)])
    back = [(r.doc_id, r.text) for r in periodic_runs.collapsed(docs).collect()]
    assert (1, "a b c") in back and (2, None) in back and (8, "w") in back and (9, ODD_TEXTS[10][1]) in back
    assert len(back) == len(ODD_TEXTS)


def test_op11_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()
    # Texts that the plain version would take hours for are left to the other tests.
    want = {r.doc_id: plain_digest(r.doc_id, r.text, True) for r in docs if len(r.text) < 9000}
    assert len(got) == len(docs)
    assert all(tuple(r) == want[r.doc_id] for r in got if r.doc_id in want)
    assert sum(r.n_runs > 0 for r in got) > 5


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_op12_on_all_documents(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = QUERIES["op12_byte_bpe"](spark, SF_DIR).collect()
    want = []
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode_bytes(ids))))
    assert ordered(got) == ordered(want)


def test_bytes_of_odd_texts(spark, library):
    rows = byte_bpe.encoded(frame(spark, ODD_TEXTS), RANKS, public_tokenizers.PATTERN).collect()
    assert ordered([(r.doc_id, r.ids) for r in rows]) == ordered([(i, library.encode_ordinary(t or "")) for i, t in ODD_TEXTS])
    texts = dict(ODD_TEXTS)
    decoder = byte_bpe.Decoder(byte_bpe.read_ranks(RANKS))
    for r in rows:
        assert r.decoded == (texts[r.doc_id] or "")
        _, starts = library.decode_with_offsets(r.ids)
        assert r.starts == starts
        assert "".join(decoder.pieces(r.ids)) == r.decoded
        # A token's characters hold its bytes.
        for i, a, b in zip(r.ids[:500], r.starts, r.ends, strict=False):
            assert decoder.tokens[i] in r.decoded[a:b].encode()
    assert byte_bpe.encoded(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=4))
def test_bytes_of_any_text(library, texts):
    encoder, decoder = byte_bpe._tools(RANKS, public_tokenizers.PATTERN)
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        ids = np.frombuffer(found, "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert decoder.to_text(ids) == text


def test_tables_that_fill_up_change_nothing(library):
    encoder = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN, pieces=1)
    texts = ["one two three", None, "two " * 50 + "é" * 100, "three"] * 3
    byte_bpe.GROUP_CHARS, before = 10, byte_bpe.GROUP_CHARS
    try:
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    finally:
        byte_bpe.GROUP_CHARS = before
    assert got == [library.encode_ordinary(t or "") for t in texts]


def test_parts_of_characters():
    decoder = byte_bpe.Decoder(byte_bpe.read_ranks(RANKS))
    single = {t: i for i, t in enumerate(decoder.tokens) if t and len(t) == 1}
    ids = [single[bytes([b])] for b in "a漢".encode()]
    assert decoder.pieces(ids) == ["a", "", "", "漢"]
    assert decoder.pieces(ids[:-1]) == ["a", "", "�"] and decoder.to_text(ids[:-1]) == "a�"
    starts, ends = decoder.offsets(np.array(ids), "a漢".encode())
    assert starts.tolist() == [0, 1, 1, 1] and ends.tolist() == [1, 2, 2, 2]


def plain_repair(rows: list[tuple]) -> tuple:
    """Counts, cost, audit and digest of (turn, role, text) in order, by a table of all nodes."""
    kinds, seen, counts = [], set(), [0, 0, 0]
    for _, role, text in rows:
        body = re.sub(r"[ \t-\r]+", "", text)
        kind = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
        seen.add((role, text))
        kinds.append(kind)
        if kind < 3:
            counts[kind] += 1
    ways = {("", 0): (0, "", ())}  # (what was said last, turns passed) -> cost, audit, repaired

    def offer(table, key, way):
        if key not in table or way[:2] < table[key][:2]:
            table[key] = way

    def next_state(last, initial):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[last].get(initial)

    for at in range(len(rows) + 1):
        for _ in range(4):
            for last, i in list(ways):
                if i == at:
                    cost, audit, done = ways[last, i]
                    for role in ("user", "assistant"):
                        if to := next_state(last, role[0]):
                            offer(ways, (to, i), (cost + 3, audit + "I", (*done, f"{role}:")))
        if at == len(rows):
            break
        _, role, text = rows[at]
        for last, i in list(ways):
            if i != at:
                continue
            cost, audit, done = ways[last, i]
            offer(ways, (last, at + 1), (cost + 4, audit + "D", done))
            if kinds[at] >= 2:
                extra = 3 * (kinds[at] == 2)
                if to := next_state(last, role[:1]):
                    offer(ways, (to, at + 1), (cost + extra, audit + "K", (*done, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    if to := next_state(last, other[0]):
                        offer(ways, (to, at + 1), (cost + 3 + extra, audit + "R", (*done, f"{other}:{text}")))
    cost, audit, done = min((ways[last, len(rows)] for last in ("", "a") if (last, len(rows)) in ways), key=lambda w: w[:2])
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *counts, illegal, cost, audit, sha("\n".join(done).encode()))


def plain_repairs(rows: list[tuple], damage: bool) -> dict:
    """conv_id -> the row of op13, from (conv_id, turn, role, text)."""
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        told = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(told.encode()) % 20 if damage else 9
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        of[conv] += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    return {c: plain_repair(sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for c, x in of.items()}


TURNS = "conv_id long, turn long, role string, text string"
ODD_TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."),
    (2, 5, "assistant", "No question"), (2, 9, "assistant", "Twice."), (2, 9, "assistant", "Twice."),
    (None, None, None, None), (None, 3, "user", "ü."), (3, 1, "tool", "x."), (3, 2, "", "y!"), (3, 4, "user", " \t\n"),
    (4, None, "user", "undated."), (4, 1, "assistant", "z" * 70_000), (5, 1, "umpire", "kept?"), (5, 2, "assistant", "a.\xa0"),
    *[(6, k // 2, ("user", "assistant", "user", "system", "bot")[k % 5], f"turn {k % 37}" + "."[: k % 3]) for k in range(700)],
]


def test_repairs_both_ways(spark):
    rows = spark.createDataFrame(ODD_TURNS, TURNS).withColumn("c", F.lit(1)).withColumn("first", F.lit("x"))
    want = plain_repairs(ODD_TURNS, False)
    for heavy in (turn_repair.HEAVY_TURNS, 100, 1, 0):
        got = turn_repair.repairs(rows, heavy_turns=heavy).collect()
        assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want), heavy


def test_repaired_turns(spark):
    rows = spark.createDataFrame(ODD_TURNS, TURNS)
    report = turn_repair.repairs(rows)
    said = defaultdict(list)
    for r in sorted(turn_repair.repaired_turns(rows, report).collect(), key=lambda r: r.place):
        said[r.conv_id].append((r.edit, r.role, r.text))
    for r in report.collect():
        turns = said[r.conv_id]
        assert sha("\n".join(f"{a}:{b}" for _, a, b in turns).encode()) == r.repaired_sha256
        assert "".join(e for e, _, _ in turns) == r.audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(a[0] for _, a, _ in turns))


def test_nothing_left(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 0), (2, 0, "user", "Hi.", 2)], TURNS + ", n int")
    for heavy in (10, 0):
        got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repairs(rows, "n", heavy).collect()}
        assert got[1] == (0, 0, 0, 0, 0, 0, "", sha(b""))
        assert got[2][:6] == (0, 0, 1, 0, 1, 7) and got[2][6] == "KDI"
    empty = spark.createDataFrame([], TURNS)
    assert turn_repair.repairs(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "bot"]), st.sampled_from(["a.", "b", "", "c!", "d."])), max_size=12), st.integers(1, 6))
def test_cheapest_of_any_turns(turns, block):
    rows = [(k, *turn) for k, turn in enumerate(turns)]
    seen, form = set(), ""
    for _, role, text in rows:
        form += turn_repair.turn_form(role, text, (role, text) in seen)[0]
        seen.add((role, text))
    before, turn_repair.BLOCK_TURNS = turn_repair.BLOCK_TURNS, block
    try:
        assert turn_repair.repair(form) == plain_repair(rows)[5:7]
    finally:
        turn_repair.BLOCK_TURNS = before


def test_op13_on_all_conversations(spark):
    for sf_dir in (SF_DIR, "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        got = QUERIES["op13_turn_repair"](spark, sf_dir).collect()
        assert {r[0]: tuple(r)[1:] for r in got} == plain_repairs(rows, True)
        assert len(got) == len({r[0] for r in rows})
