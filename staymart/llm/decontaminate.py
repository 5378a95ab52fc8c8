"""Benchmark items found in documents, with SimHash windows and Hamming blocks; SQL functions only.

Words are runs of letters, marks and digits in lower case. A shingle is five words in a row
(all words of an item that has fewer) and weighs its number of characters; the similarity of
two word sequences is the weighted Jaccard of their shingles with repeats: sum of the smaller
over sum of the larger weights. A document holds an item if a window of the item's number of
words (the whole document, if it is shorter) reaches ``PERCENT``; windows stand where a shingle
of the item lies on the same shingle of the document.

Only windows that share a shingle with an item can have a similarity over zero. So every such
window gets a 64-bit SimHash of its weighted shingles, and
no other. Fingerprints and items meet in RADIUS + 1 blocks of bits: if at most RADIUS bits
differ, one block is equal. At the threshold about 10 bits differ, with a deviation of 3;
RADIUS is 23. Candidates are verified by the exact similarity. Equal windows are handled once.

Null or empty texts and items hold nothing. Null ids are reported as null. Repeated rows and
items are found each; of several windows for one document and item the best, then the first
counts. Further columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import keep

SHINGLE, PERCENT, RADIUS = 5, 80, 23
#: Item shingles that are sent to every task; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def word_list(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{M}\p{N}]+"), "")


def shingled(frame: DataFrame, n: int = SHINGLE) -> DataFrame:
    """Rows of ``frame`` (with array ``words``) times their shingles: ``at``, ``h``, ``w``.

    ``n`` is the number of words of a shingle.
    """
    rows = frame.where(F.size("words") >= n).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - n)))
    parts = [F.element_at("words", F.col("at") + (k + 1)) for k in range(n)]
    weight = sum((F.length(p) for p in parts[1:]), F.length(parts[0])).cast("long")
    return rows.select("*", F.xxhash64(*parts).alias("h"), weight.alias("w"))


def fingerprint(shingles: Column) -> Column:
    """SimHash of an array of (h, w)."""

    def bit(i: Column) -> Column:
        up = F.aggregate(
            shingles,
            F.lit(0).cast("long"),
            lambda total, s: total + F.when(F.call_function("getbit", s["h"], i) == 1, s["w"]).otherwise(-s["w"]),
        )
        return F.when(up > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(0)

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def blocks(h: Column, radius: int = RADIUS) -> Column:
    """The fingerprint's bits in radius + 1 blocks, as an array of long."""
    n = radius + 1
    edges = [64 * k // n for k in range(n + 1)]
    return F.array(*(F.shiftrightunsigned(h, a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)))


def _weights(frame: DataFrame, key: str, k: int) -> DataFrame:
    """(key, h, w): weight of each distinct shingle."""
    return shingled(frame, k).groupBy(key, "h").agg(F.sum("w").alias("w"))


def _prints(weights: DataFrame, key: str) -> DataFrame:
    """(key, total, fingerprint) from (key, h, w)."""
    per = weights.groupBy(key).agg(F.sum("w").alias("total"), F.collect_list(F.struct("h", "w")).alias("s"))
    return per.select(key, "total", fingerprint(F.col("s")).alias("print"))


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity), a row per document and item it holds."""
    its = items.select(F.col(item_id).alias("item_id"), word_list(item_text).alias("words")).where(F.size("words") > 0)
    its = keep(its.select("item_id", "words", F.size("words").alias("n"), F.xxhash64("words").alias("item")))
    d = docs.select(F.col(doc_id).alias("doc_id"), word_list(text).alias("words"))
    small = its.agg(F.sum("n")).first()[0] or 0
    found = None
    # Shorter items have shingles of their own length.
    for (k,) in its.select(F.least("n", F.lit(SHINGLE))).distinct().collect():
        mine = its.where(F.col("n") == k) if k < SHINGLE else its.where(F.col("n") >= k)
        one = _found(d, mine.dropDuplicates(["item"]).drop("item_id"), k, small <= BROADCAST_ROWS)
        found = one if found is None else found.union(one)
    if found is None:
        found = _found(d, its.drop("item_id"), SHINGLE, True)
    return found.join(its.select("item", "item_id").distinct(), "item").select("doc_id", "item_id", "start", "n_words", "similarity")


def _found(d: DataFrame, its: DataFrame, k: int, small: bool) -> DataFrame:
    sent = F.broadcast if small else (lambda frame: frame)
    anchors = shingled(its, k).select("h", F.col("at").alias("q"), "n").distinct()
    hits = shingled(d, k).join(sent(anchors), "h")
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("q"), F.size("words") - F.col("n")))
    window = F.array_join(F.slice("words", start + 1, F.col("n")), " ")
    # Every window once per task before the shuffle.
    windows = keep(hits.select("doc_id", start.alias("start"), window.alias("window")).distinct())

    texts = windows.select("window").distinct().withColumn("words", F.split("window", " "))
    w_weights = keep(_weights(texts, "window", k))
    i_weights = keep(_weights(its, "item", k))
    w_prints, i_prints = _prints(w_weights, "window"), _prints(i_weights, "item")
    a = w_prints.select("window", F.col("total").alias("w_total"), F.col("print").alias("w_print"), F.posexplode(blocks(F.col("print"))).alias("block", "bits"))
    b = i_prints.select("item", F.col("total").alias("i_total"), F.col("print").alias("i_print"), F.posexplode(blocks(F.col("print"))).alias("block", "bits"))
    near = F.bit_count(F.col("w_print").bitwiseXOR(F.col("i_print"))) <= RADIUS
    sizes = F.least("w_total", "i_total") * 100 >= F.greatest("w_total", "i_total") * PERCENT
    candidates = a.join(sent(b), ["block", "bits"]).where(near & sizes).select("window", "item", "w_total", "i_total").distinct()

    shared = (
        candidates.join(w_weights, "window")
        .join(sent(i_weights.select("item", "h", F.col("w").alias("i_w"))), ["item", "h"])
        .groupBy("window", "item")
        .agg(F.sum(F.least("w", "i_w")).alias("shared"), F.first(F.col("w_total") + F.col("i_total")).alias("both"))
        .where(F.col("shared") * 100 >= (F.col("both") - F.col("shared")) * PERCENT)
        .select("window", "item", (F.col("shared") / (F.col("both") - F.col("shared"))).alias("similarity"))
    )
    held = windows.join(shared, "window")
    best = held.groupBy("doc_id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("first"), F.size(F.split("window", " ")).alias("n"))).alias("best")
    )
    return best.select(
        "doc_id", "item", (-F.col("best.first")).alias("start"), F.col("best.n").alias("n_words"), F.col("best.similarity").alias("similarity")
    )


def without_benchmark(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that hold an item; same columns.

    A text decides on its own rows, whatever their ids: clean rows stay beside contaminated
    ones with the same or no id. Texts are told apart by 128 bits of hashes.
    """
    key = F.struct(F.xxhash64(F.col(text)).alias("a"), F.xxhash64(F.lit(1), F.col(text)).alias("b"))
    columns = docs.columns
    keyed = docs.withColumn("__text_key", key)
    gone = contaminated(keyed, items, "__text_key", text).select(F.col("doc_id").alias("__gone_key")).distinct()
    return keyed.join(gone, F.col("__text_key") == F.col("__gone_key"), "left_anti").select(*[F.col(f"`{c}`") for c in columns])
