"""Documents made ready for training: five operators in a row, each stage written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderlake.llm import decontaminate, packing, quality, simhash, suffix
from orderlake.llm.common import read, settings, shared_directory

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    settings(spark)
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    settings(spark)
    return simhash.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that an earlier passage repeats; ``n_chars`` follows the text."""
    settings(spark)
    return suffix.without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark is found."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of at most 2048 tokens."""
    settings(spark)
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark leaks", benchmark_leaks),
    ("packed sequences", packed_sequences),
]

#: The suffix matches, fingerprints and token packing of the stages are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the shared folder."""
    root = f"{shared_directory(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
