"""From raw documents to token ids: five stages, each one of the operators in registra/llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from registra.llm.common import settled, small_batches
from registra.llm.decontaminate import drop_contaminated
from registra.llm.exact_dedup import drop_exact_copies
from registra.llm.language_id import drop_unidentified
from registra.llm.sentencepiece_codec import encode_and_decode
from registra.llm.simhash import drop_near_copies

SHINGLE = 3
RADIUS = 3
MODEL = "piece_bpe_32k.model"


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows."""
    small_batches(spark)
    return drop_unidentified(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_exact_copies(docs, keep="largest")


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id."""
    small_batches(spark)
    return drop_near_copies(docs, shingle=SHINGLE, radius=RADIUS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    small_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, the text that they decode to, and whether it is the text of the document."""
    small_batches(spark)
    return encode_and_decode(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("language_id", identified),
    ("exact_dedup", distinct),
    ("simhash_near_dedup", apart),
    ("decontamination", uncontaminated),
    ("sentencepiece", tokenized),
]

# Language identification and the lattice are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
