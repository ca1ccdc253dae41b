"""A corpus pipeline of five stages: language, exact copies, near copies, benchmark passages, packing.

Every stage takes all rows its predecessor kept. The first four return the columns of ``documents``,
whatever others there are; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, exact_dedup, jaccard_join, lang_id, packing
from tallyframe.llm.common import staged
from tallyframe.session import tune


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in a learned language; what has no letter or no clear language goes."""
    return lang_id.accepted(docs)


def one_of_equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def one_of_similar_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts, the row with the smallest doc_id."""
    return jaccard_join.drop_similar(docs)


def without_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that overlap with no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", one_of_equal_texts),
    ("jaccard_join", one_of_similar_texts),
    ("decontamination", without_benchmark_passages),
    ("packing", packed),
]

#: Language models and token merges have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
