"""The corpus pipeline: from documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Between
stages the rows are written as Parquet and read again. All but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staymart.llm import pieces
from staymart.llm.bradley_terry import without_low_quality
from staymart.llm.decontaminate import without_benchmark
from staymart.llm.hyperminhash import without_near_duplicates
from staymart.llm.line_dedup import without_repeated_lines
from staymart.llm.queries import ORACLES as OPERATOR_ORACLES
from staymart.llm.queries import QUERIES as OPERATOR_QUERIES
from staymart.llm.scratch import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking doesn't reject; it learns from all labels."""
    return without_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; those left without words go."""
    return without_repeated_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8)."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the end id, and the text decoded from them."""
    import public_tokenizers

    rows = pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Learned scores and a tokenizer's merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = keep(docs)
    return docs


QUERIES = OPERATOR_QUERIES | {"pipeline": run}
ORACLES = OPERATOR_ORACLES | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
