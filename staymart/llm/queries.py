"""One query per corpus operator, over whole tables with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import bradley_terry, byte_bpe, chat_windows, periodic_runs, pieces, secret_forest, surrogates, toxicity, turn_repair
from .decontaminate import contaminated
from .hyperminhash import near_duplicates
from .labelled import fold
from .line_dedup import line_report
from .neighbour_graph import nearest
from .scratch import keep

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_neighbour_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the lines that repeat an earlier one at Jaccard 0.8 or more."""
    return line_report(_table(spark, sf_dir, "documents"))


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of two folds of three are learned from."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ranking = bradley_terry.train(docs, labels.where(~fold("doc_id", 3, 1)))
    rows = bradley_terry.scored(docs.select("doc_id", "text"), ranking)
    return rows.select("doc_id", fold("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of four folds of five are learned from."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~fold("doc_id", 5, 0)))
    rows = toxicity.scored(docs, model)
    return rows.select("doc_id", fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with surrogates for its personal data."""
    return surrogates.with_surrogates(_table(spark, sf_dir, "documents"), b"a key for the tables of the query")


def op3_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret with the forest's score."""
    docs = _table(spark, sf_dir, "documents")
    found = keep(secret_forest.candidates(docs))
    rows = secret_forest.scored(found, secret_forest.rule_labels(found), secret_forest.dictionary(docs))
    return rows.select("doc_id", "word_no", F.length("candidate").alias("n_chars"), F.sha2("candidate", 256).alias("sha256"), "score", "secret")


def op4_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their four-word shingles."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of one full of markers, read back from their windows."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat_windows.digests(keep(chat_windows.windows(turns.union(marked))))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them, per document."""
    import public_tokenizers

    return pieces.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """For each tenth document by hash: from some word on, the first few words from there again and again."""
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, after some tails are made to repeat."""
    return periodic_runs.digests(_table(spark, sf_dir, "documents"), repeated_tail)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the bytes decoded from them, per document."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repairs of every conversation, after some of its turns are damaged."""
    told = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    turns = _table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        *[F.coalesce(name, F.lit(" ")).alias(name) for name in ("role", "text")],
        (F.crc32(F.concat(told[0], F.lit(":"), told[1])) % 20).alias("damage"),
    )
    damaged = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "")
        .when(F.col("damage") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("damage") == 0, 0).when(F.col("damage") == 3, 2).otherwise(1).alias("copies"),
    )
    return turn_repair.repairs(damaged, "copies")


QUERIES: dict[str, Query] = {
    "op1_bradley_terry": op1_bradley_terry,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_secret_forest": op3_secret_forest,
    "op5_toxicity": op5_toxicity,
    "op4_hyperminhash": op4_hyperminhash,
    "op6_simhash_decontamination": op6_simhash_decontamination,
    "op7_chat_windows": op7_chat_windows,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_neighbour_graph": op9_neighbour_graph,
    "op10_line_dedup": op10_line_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_turn_repair": op13_turn_repair,
}

ORACLES: dict[str, str] = {}
