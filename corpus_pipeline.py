"""A training corpus from raw documents: known languages, no duplicates, no benchmark text, packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.decontaminate import drop_contaminated
from touchline.llm.exact_dedup import drop_duplicates
from touchline.llm.language import UNKNOWN, identify, learn_profiles
from touchline.llm.minhash import near_duplicates
from touchline.llm.packing import pack_documents
from touchline.llm.text import bounded_batches
from touchline.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Bytes of an Arrow batch here. An executor holds several for each task, and its workers keep what earlier stages loaded.
BATCH = 2 << 20


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the profiles are learned from all rows that state one.

    A document without a letter, or without text, is rejected.
    """
    bounded_batches(spark, BATCH)
    lang, score = "lang_pred__", "lang_score__"
    named = identify(docs, learn_profiles(docs), lang_name=lang, score_name=score)
    return named.filter(F.col(lang) != UNKNOWN).drop(lang, score)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group of equal texts: the one with the largest id."""
    return drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group linked by five-word shingles at a similarity of 0.8 or more: the one with the least id."""
    bounded_batches(spark, BATCH)
    dropped = near_duplicates(docs, words=5).filter(~F.col("kept")).select(F.col("doc_id").alias("dropped__"))
    return docs.join(dropped, F.col("doc_id") == F.col("dropped__"), "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    bounded_batches(spark, BATCH)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 token ids."""
    bounded_batches(spark, BATCH)
    return pack_documents(docs, TOKENIZER, with_ids=False)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Rank-order profiles and a tokenizer cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what one keeps is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
