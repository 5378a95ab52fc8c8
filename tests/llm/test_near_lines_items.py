"""Near duplicates, line dedup and decontamination against brute force on awkward rows."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staymart.llm import hyperminhash, rarity, words
from staymart.llm.decontaminate import contaminated, without_benchmark
from staymart.llm.graph import components
from staymart.llm.line_dedup import line_report, line_table, without_repeated_lines

RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(60)] + ["Ünï", "der", "THE", "x" * 300]


def sentence(n: int) -> str:
    return " ".join(RNG.choices(VOCABULARY, k=n))


def edited(text: str, changes: int) -> str:
    w = text.split(" ")
    for _ in range(changes):
        w[RNG.randrange(len(w))] = f"new{RNG.randrange(1000)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def texts():
    base = [sentence(n) for n in (1, 2, 3, 4, 5, 9, 40, 40, 120, 120, 3000)]
    rows = [*base, *base[:6], "", None, " \t\n ", "THE the The", "the THE THE"]
    rows += [edited(t, k) for t in base[6:] for k in (1, 1, 2, 4)]
    # A chain: every text is near the next one only, and a family around one text.
    chain = base[8].split(" ")
    rows += [" ".join(chain[k * 4 :] + [f"c{j}" for j in range(k * 4)]) for k in range(8)]
    rows += [edited(base[9], 3) for _ in range(40)]
    RNG.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates(spark, texts, shingle):
    got = hyperminhash.near_duplicates(brute.frame(spark, texts), shingle=shingle).collect()
    want = brute.near_components(texts, shingle)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing_and_null_ids(spark):
    assert hyperminhash.near_duplicates(brute.frame(spark, [])).count() == 0
    rows = [(None, "a b c d e"), (None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (4, None)]
    got = sorted(hyperminhash.near_duplicates(brute.frame(spark, rows)).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [
        (3, 3, True), (3, 3, True), (4, 4, True), (None, None, True), (None, None, True),
    ]


def test_links_of_repeated_ids(spark):
    """Document 3 stands with two texts; 9 is close to the second, 1 to the first."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(3, a), (3, b), (9, b + " more"), (5, "of its own " * 9), (3, b)]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in hyperminhash.near_duplicates(brute.frame(spark, rows)).collect()}
    assert got[9, 58] == (3, False) and got[3, 57] == (3, True) and got[5, 3] == (5, True)
    both = hyperminhash.near_duplicates(brute.frame(spark, [*rows, (1, "and " + a)])).collect()
    assert {r.doc_id: r.component_id for r in both} == {1: 1, 3: 1, 9: 1, 5: 5}


def test_near_duplicates_keep_columns_with_any_name(spark, texts):
    docs = brute.frame(spark, texts).withColumns({"component_id": F.lit("x"), "n_shingles": F.lit(1), "kept": F.lit(None)})
    left = hyperminhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    want = brute.near_components(texts, 5)
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_registers_estimate_similarity():
    rng = np.random.Generator(np.random.PCG64(1))
    for overlap in (0, 3000, 6000, 9000):
        a = np.unique(words.mix(rng.integers(0, 1 << 63, 10_000).astype(np.uint64)))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[:overlap]], words.mix(rng.integers(0, 1 << 63, 10_000 - overlap).astype(np.uint64))]))
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = hyperminhash.registers([a]), hyperminhash.registers([b])
        got = hyperminhash.estimates(x, y, np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(got - exact) < 5 * 0.5 / 128**0.5


def test_registers_of_small_sets_are_full():
    s = [np.array([5], np.uint64), np.array([], np.uint64), np.array([1, 1 << 63], np.uint64)]
    r = hyperminhash.registers(s)
    assert (r[0] == r[0][0]).all() and (r[1] == 0xFFFF).all() and len(np.unique(r[2])) == 2


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 30)] + [(100, 107), (107, 103), (50, 50), (200, 201), (201, 200)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(1, 31)}, 107: 100, 103: 100, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def lined(texts):
    base = [sentence(n) for n in (1, 3, 4, 5, 5, 10, 30, 80)]
    rows = []
    for k in range(30):
        parts = [RNG.choice(base) for _ in range(4)] + [edited(RNG.choice(base), 1), sentence(6), "", "  "]
        RNG.shuffle(parts)
        rows.append((k * 3 - 20, "\n".join(parts)))
    # Many near copies of one line.
    rows += [(200 + k, edited(base[7], k % 9)) for k in range(80)]
    return rows + [(900, None), (901, ""), (902, "\n\n"), (903, "One\nONE\none"), (904, "a b c d e\na b c d\n\ne d c b a")]


def test_line_report(spark, lined):
    got = line_report(brute.frame(spark, lined)).collect()
    want = brute.repeated(lined)
    assert {r.doc_id: [int(x) for x in r.removed_lines.split(",")] for r in got if r.n_removed} == want
    assert {r.doc_id: r.n_lines for r in got} == {i: len((t or "").split("\n")) for i, t in lined}


def test_lines_are_cut(spark, lined):
    docs = brute.frame(spark, lined).withColumns({"line": F.lit(7), "removed": F.lit("x"), "row_key": F.lit(1)})
    got = {r.doc_id: r.text for r in without_repeated_lines(docs).collect()}
    gone = brute.repeated(lined)
    want = {}
    for i, text in lined:
        left = [x for k, x in enumerate((text or "").split("\n")) if k not in gone.get(i, [])]
        if i not in gone:
            want[i] = text
        elif any(brute.byte_words(x) for x in left):
            want[i] = "\n".join(left)
    assert got == want
    assert without_repeated_lines(docs).columns == docs.columns


def test_lines_of_nothing_and_of_repeated_rows(spark):
    assert line_report(brute.frame(spark, [])).count() == 0
    assert without_repeated_lines(brute.frame(spark, [])).count() == 0
    rows = [(None, "a b c\nx"), (None, "a b c\nx"), (1, "a b c\ny"), (1, "a b c\nz"), (1, "q\nq")]
    got = sorted(r.text for r in without_repeated_lines(brute.frame(spark, rows)).collect())
    # A null id stands first; rows with one id go by their texts.
    assert got == ["a b c\nx", "a b c\nx", "q", "y", "z"]


def test_texts_of_one_id_with_the_same_words_are_told_apart(spark):
    rows = [(1, "a b c d\nx y"), (1, "x y\na b c d"), (2, "y X"), (2, "q")]
    got = {r.text for r in without_repeated_lines(brute.frame(spark, rows)).collect()}
    # Of the first two texts either may come first; the other then has nothing left.
    assert got in ({rows[0][1], "q"}, {rows[1][1], "q"})


def test_counts_of_words_are_handed_on_by_slices(spark):
    docs = brute.frame(spark, [(k, " ".join(f"v{j}" for j in range(k, 20_000, 2))) for k in range(2)]).coalesce(1)
    table = line_table(docs, "doc_id", "text", rarity.RARITY_BITS)
    assert table.where("line IS NULL").count() <= 1 << 10


def test_levels_of_packed_counts(spark):
    counts = np.random.default_rng(3).integers(0, 3, (2, 1 << 14)) * [[1], [70]]
    counts[0, 5:4200] = 0
    counts[1, 4100] = 70_000

    def tasks(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays(rarity.packed(counts[k]), ["slice", "places", "counts"])

    rows = spark.range(0, 2, 1, 2).mapInArrow(tasks, "slice int, places binary, counts binary")
    got = rarity.packed_levels(rows, 14)
    assert (got == rarity._level(np.minimum(counts, 65_535).sum(0))).all()


@pytest.fixture(scope="module")
def items():
    rows = [(k, " ".join(RNG.choices([f"b{j}" for j in range(40)], k=n))) for k, n in enumerate((1, 3, 5, 8, 20, 45, 60))]
    return [*rows, (50, None), (51, "--- "), (52, rows[4][1])]


def test_contaminated(spark, texts, items):
    rows = [(i, t) for i, t in texts if t is None or len(t) < 2000]
    for at, (_, item) in enumerate(items):
        if item:
            rows.append((500 + at, f"{sentence(20)} {item.upper()}!! {sentence(10)}"))
            rows.append((600 + at, f"{sentence(3)}, {edited(item, 1)}."))
            rows.append((700 + at, item[: len(item) // 2]))
    docs = brute.frame(spark, rows).withColumns({"item_id": F.lit(1), "window": F.lit("w"), "h": F.lit(2)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(docs, bench).collect()}
    want = brute.held_items(rows, items)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    left = without_benchmark(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {d for d, _ in want}


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark):
    item = " ".join(f"q{i}" for i in range(20))
    rows = [(None, "clean text"), (None, f"so {item} it is"), (None, None), (7, "clean too"), (7, item), (8, item), (8, "")]
    docs = brute.frame(spark, rows)
    left = without_benchmark(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == docs.columns
    want = [(None, "clean text"), (None, None), (7, "clean too"), (8, "")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)


def test_contaminated_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = brute.frame(spark, [(1, "a b c d e f"), (None, None)])
    assert contaminated(docs, bench).count() == 0
    assert without_benchmark(docs, bench).count() == 2
    some = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert contaminated(brute.frame(spark, []), some).count() == 0


def test_contaminated_plan_has_no_python(spark, texts, items):
    plan = contaminated(brute.frame(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
