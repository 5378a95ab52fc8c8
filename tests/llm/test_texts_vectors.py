"""Pieces, chat windows, surrogates and the neighbour graph: exact round trips and brute force."""

from __future__ import annotations

import hashlib
import random
import re

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staymart.llm import chat_windows, neighbour_graph, pieces, surrogates

MODEL = public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [None, "", " ", "   ", "a", " a", "a ", "a  b", "▁", "▁▁ x", "\n \t", "\0", "漢字 漢字", "ﬁ é é", "</s> <s> <unk> <0x0A>", "x" * 3000, "é" * 2000, "w " * 30_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def table(library):
    return pieces.ChunkTable(library, chunks=50)


@given(st.text(max_size=60) | st.text("a b▁\n\0é漢x<>/s", max_size=60))
@settings(max_examples=400, deadline=None)
def test_chunks_encode_as_the_library_does(library, table, text):
    [(joined, n, back)] = table.encode([text])
    ids = library.encode(text)
    assert joined == " ".join(map(str, ids)) and n == len(ids) and back == library.decode(ids)


def test_encoded_and_digests(spark, library):
    docs = brute.frame(spark, [*enumerate(AWKWARD), (None, "b"), (3, AWKWARD[3])]).withColumn("ids", F.lit("x"))
    got = pieces.encoded(docs, MODEL).collect()
    assert len(got) == len(AWKWARD) + 2
    for r in got:
        text = "b" if r.doc_id is None else AWKWARD[r.doc_id] or ""
        assert r.ids == [*library.encode(text), library.eos_id()] and r.decoded == library.decode(r.ids)
    for r in pieces.digests(docs, MODEL).collect():
        ids = [*library.encode("b" if r.doc_id is None else AWKWARD[r.doc_id] or ""), library.eos_id()]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.encoded(docs.where("false"), MODEL).count() == 0


TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(9)
    nasty = ["\\### Assistant: </turn> ok", "</turn>\n", "\\l\\e\\h\\c", "a: b: c", "# < \\", "\\", "", None, "é" * 40, "w " * 300]
    rows = []
    for conv in range(25):
        if conv % 3 == 0:
            rows.append((conv, 0, "system", "be " * rng.randrange(1, 8)))
        for k in range(rng.randrange(0, 30)):
            role = rng.choice(["user", "assistant", "assistant", "tool: x", None, "system"])
            rows.append((conv, k + 1, role, rng.choice([*nasty, "word " * rng.randrange(20)])))
    rows += [(900, 1, "user", "q"), (900, 1, "user", "q"), (900, 1, "assistant", "r"), (None, None, "user", "lost"), (901, 5, "system", "alone")]
    return rows


def ordered(rows):
    def key(r):
        return [(x is not None, x) for x in r[1:2]] + [r[2] or "", r[3] or ""]

    out: dict = {}
    for r in sorted(rows, key=lambda r: str(key(r))):
        out.setdefault(r[0], []).append(r)
    return {c: sorted(rs, key=key) for c, rs in out.items()}


@pytest.mark.parametrize(("budget", "history"), [(1024, 256), (40, 15), (12, 0)])
def test_windows_read_back(spark, turns, budget, history):
    frame = spark.createDataFrame(turns, TURNS).withColumns({"k": F.lit("x"), "tokens": F.lit(1), "system": F.lit(0)})
    made = chat_windows.windows(frame, budget, history)
    got = {r.conv_id: r for r in chat_windows.digests(made).collect()}
    want = ordered(turns)
    assert set(got) == set(want)
    for conv, rows in want.items():
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows)
        lost = "".join(r[3] or "" for r in rows if r[2] == "assistant")
        assert got[conv].n_turns == len(rows)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_chars == len(lost)
        assert got[conv].loss_sha256 == hashlib.sha256(lost.encode()).hexdigest()
    for w in made.collect():
        written = w.formatted.split("</turn>\n")[:-1]
        assert len(written) == w.n_context + w.n_targets and w.n_targets > 0
        rows = want[w.conv_id]
        if rows[0][2] == "system":
            assert written[0].startswith("### system: ")
        # Over the budget only with one target besides a system turn, or a system turn that fills it.
        system = len((rows[0][3] or "").split()) + 4 if rows[0][2] == "system" else 0
        assert w.over_budget == (w.n_tokens > budget)
        assert not w.over_budget or w.n_targets <= 2 or system + history >= budget


def test_windows_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat_windows.digests(chat_windows.windows(empty)).count() == 0
    with pytest.raises(ValueError, match="history"):
        chat_windows.windows(empty, 10, 10)


def test_surrogates_keep_type_layout_and_coreference():
    draws = surrogates.Draws(b"key")
    text = "Jo.81@mail7.example.com, jo.81@MAIL7.example.com +1 (918) 555-3922 or 1-918-555-3922; 10.2.3.4 4111 1111 1111 1111 4111111111111111 Mr. Smith, Mary Smith, Елена Петрова"
    out, n = draws.replaced(text, {})
    assert n == 10
    a, b = re.findall(r"\S+@\S+\.com", out)
    assert a.lower() == b.lower() and a != text.split(",")[0] and a[0].isupper() and a.endswith(".com")
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|1-\d{3}-\d{3}-\d{4}", out)
    assert len(phones) == 2 and re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1])
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", out)
    assert len(cards) == 2 and cards[0].replace(" ", "") == cards[1] and surrogates._checks(cards[1])
    first, last = re.search(r"(\w+) (\w+), (\w+) (\w+)$", out).group(1, 4)
    assert first in surrogates.FIRST["f", "latin"] and "Smith" not in out and out.count(re.search(r"Mr\. (\w+)", out).group(1)) == 2
    assert "Ѐ" <= last[0] <= "ӿ"
    assert surrogates.Draws(b"other").replaced(text, {})[0] != out
    assert draws.replaced("nothing of the kind 12 3.4.5", {}) == ("nothing of the kind 12 3.4.5", 0)


@pytest.mark.parametrize(
    "address",
    ["über.23@mail6.example.com", "émile@x.fr", "_ann@x.org", "ann@müller.de", "иван@почта.рф", "-ann@x.org", ".ann+b@x.org",
     "%ann@x.org", "mu\u0308ller@x.org", "νίκος@x.gr", "a@xn--80a.xn--p1ai"],
)
def test_addresses_in_any_script(address):
    draws = surrogates.Draws(b"key")
    (said,) = surrogates.mentions(f"to {address}, now")
    bare = address.lstrip(".+%-")
    assert "".join(piece for _, piece in said[2]) == bare
    out, n = draws.replaced(f"to {address}, now", {e: 4 for _, _, pieces in [said] for e, _ in pieces if e})
    assert n == 1 and out.startswith("to ") and out.endswith(", now")
    local, host = bare.split("@")
    assert local not in re.split("[ @]", out) and host not in out
    for a, b in zip(bare.rpartition("@")[0], out[out.index(" ") + 1 + len(address) - len(bare) :], strict=False):
        if a.isalpha():
            assert ("Ѐ" <= a <= "ӿ") == ("Ѐ" <= b <= "ӿ")


def test_address_scan_is_linear():
    long = "a-.+" * 50_000
    assert list(surrogates.mentions(f"@ {long} {'-' * 200_000} {long}")) == []


def test_draws_that_meet_are_drawn_again(spark):
    # 256 possible draws, of which 60 occur as entities.
    def narrow(key: bytes, entity: tuple[str, str], attempt: int) -> str:
        return hashlib.sha256(f"{entity[1]}{attempt}".encode()).hexdigest()[:2]

    forms = [f"{i:02x}" for i in range(60)]
    entities = spark.createDataFrame([("x", f) for f in forms], "kind string, form string")
    attempts = dict.fromkeys(forms, 0) | {r.form: r.attempt for r in surrogates.redrawn(entities, b"k", narrow).collect()}
    drawn = [narrow(b"k", ("x", f), a) for f, a in attempts.items()]
    assert len(set(drawn)) == len(forms) and not set(drawn) & set(forms)


def test_forms_grow_where_short_ones_run_out(spark):
    draws = surrogates.Draws(b"key")
    # One letter gives 26 forms; more draws than that must give others.
    for entity in ("email", "a@example.com"), ("domain", "a.com"), ("phone", "1222222"):
        assert len(draws.normal(entity, 9)) > len(entity[1])
    assert len({draws.normal(("email", "a@example.com"), a) for a in range(40)}) > 26
    forms = [f"{chr(97 + i)}@example.com" for i in range(20)] + ["_@example.com"]
    docs = brute.frame(spark, [(i, f"to {form} now") for i, form in enumerate(forms)])
    got = {r.doc_id: r.text for r in surrogates.with_surrogates(docs, b"key").collect()}
    said = [got[i].split()[1] for i in range(len(forms))]
    assert len(set(said)) == len(forms) and not set(said) & set(forms)
    assert len({s.partition("@")[2] for s in said}) == 1
    assert not {s.partition("@")[0] + "@example.com" for s in said} & set(forms)


def test_longer_draws_keep_the_layout():
    draws = surrogates.Draws(b"key")
    shown = draws.shown(("phone", "1222222"), 3, "+1 22 22 22")
    assert re.fullmatch(r"\+1 \d\d \d\d \d\d\d", shown)
    assert draws.shown(("email", "ab@x.org"), 4, "AB").isupper() and len(draws.shown(("email", "ab@x.org"), 4, "AB")) == 4
    card = draws.shown(("card", "4111111111111111"), 3, "4111 1111 1111 1111")
    assert surrogates._checks(re.sub(r"\D", "", card)) and len(card) == 20


def test_surrogates_over_documents(spark):
    rows = [(1, "mail a.1@x.org"), (2, "again a.1@x.org and b.2@x.org"), (3, None), (4, ""), (None, "1.2.3.4"), (2, "1.2.3.4")]
    docs = brute.frame(spark, rows).withColumns({"draws": F.lit("x"), "found_id": F.lit(1)})
    got = sorted(((r.doc_id, r.text, r.n_mentions) for r in surrogates.with_surrogates(docs, b"k").collect()), key=str)
    by = {(i, n): t for i, t, n in got}
    assert by[3, 0] is None and by[4, 0] == ""
    assert by[1, 1].split()[1] == by[2, 2].split()[1] != by[2, 2].split()[3]
    assert by[None, 1] == by[2, 1] != "1.2.3.4"
    assert surrogates.with_surrogates(docs.where("false"), b"k").count() == 0


def exact(rows, k, asked):
    out = {}
    for q, x in rows:
        if asked(q):
            near = sorted(((-float(np.dot(x, y)), v) for v, y in rows if v != q and len(y) == len(x)))
            out[q] = [v for _, v in near[:k]]
    return out


@pytest.mark.parametrize("scale", [1.0, 20.0])
def test_neighbours_recall_and_scores(spark, scale):
    rng = np.random.Generator(np.random.PCG64(8))
    x = rng.normal(size=(1200, 16)).astype(np.float32)
    x *= 1 + (scale - 1) * rng.random((1200, 1)).astype(np.float32)
    x[100:300] = x[100]  # a very common vector
    x[300:500] = x[300] + 1e-4 * rng.normal(size=(200, 16)).astype(np.float32)
    rows = [(int(i), v.astype(float).tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"dim": F.lit("x"), "shard": F.lit(1)})
    got = neighbour_graph.nearest(frame, F.col("vec_id") % 10 == 0, k=20, shard=400).collect()
    want = exact([(i, np.array(v)) for i, v in rows], 20, lambda q: q % 10 == 0)
    found: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        assert abs(r.score - float(np.dot(x[r.query_id].astype(float), x[r.vec_id].astype(float)))) < 1e-9 * max(1, abs(r.score))
        found.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    assert set(found) == set(want)
    assert all([a[0] for a in v] == list(range(1, 21)) and [a[1:] for a in v] == sorted(a[1:] for a in v) for v in found.values())
    recall = np.mean([len({v for *_, v in found[q]} & set(w)) / 20 for q, w in want.items()])
    assert recall > 0.95
    # Copies of one vector tie: the smallest ids.
    assert [v for *_, v in found[110]][:5] == want[110][:5]


def test_neighbours_over_many_shards(spark):
    """The beam of a shard shrinks with their number, the recall does not."""
    beams = [neighbour_graph.shard_beam(n, 20, 160) for n in (1, 2, 7, 100, 10**6)]
    assert beams[0] == 160 and beams == sorted(beams, reverse=True) and beams[-1] >= 64
    rng = np.random.Generator(np.random.PCG64(10))
    x = rng.normal(size=(20, 32))[rng.integers(0, 20, 3600)] + rng.normal(size=(3600, 32))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbour_graph.nearest(frame, F.col("vec_id") % 20 == 0, k=20, shard=400).collect()
    found: dict = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x[::20] @ x.T
    scores[np.arange(180), np.arange(0, 3600, 20)] = -2
    want = np.argsort(-scores, 1)[:, :20]
    assert np.mean([len(found[20 * i] & set(w.tolist())) / 20 for i, w in enumerate(want)]) > 0.97


@pytest.mark.parametrize("longer", [1e4, 1e20, 1e160, 1e300])
def test_neighbours_beside_one_much_longer_vector(spark, longer):
    rng = np.random.Generator(np.random.PCG64(9))
    x = rng.normal(size=(1000, 16))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    x[7] *= longer
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbour_graph.nearest(frame, F.col("vec_id") % 10 == 0, k=20, shard=600).collect()
    found: dict = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = exact(list(enumerate(x)), 20, lambda q: q % 10 == 0)
    assert np.mean([len(found.get(q, set()) & set(w)) / 20 for q, w in want.items()]) > 0.95
    assert all(7 in found[q] for q, w in want.items() if 7 in w)


def test_bands_of_length():
    x = np.array([[1.0, 0], [1e308, 1e308], [0, 7.9], [5e-324, 0], [1e-3, 0]])
    assert [b.tolist() for b in neighbour_graph._bands(x)] == [[1], [0, 2], [4], [3]]


def test_neighbours_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, []), (1, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbour_graph.nearest(frame, F.lit(True), k=3).collect())
    assert got == [(0, 1, 1, 0.5), (0, 2, 1, 0.5), (1, 1, 0, 0.5), (1, 2, 0, 0.5)] or got[:2] == [(0, 1, 1, 0.5), (0, 2, 1, 0.5)]
    assert neighbour_graph.nearest(frame.where("false"), F.lit(True)).count() == 0
