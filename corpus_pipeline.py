"""From raw documents to packed training sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that the one before kept; its result is
written and read again before the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import language, mixing, packing
from larder.llm.common import prepare
from larder.llm.exact_dedup import drop_copies
from larder.llm.near_dedup import drop_near_duplicates
from larder.llm.vocabulary import tokenizer_file
from larder.workspace import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told."""
    prepare(spark)
    return language.keep_known(docs, language.train(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    prepare(spark)
    return drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 and more."""
    prepare(spark)
    return drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which rare sources, languages and topics weigh more."""
    prepare(spark)
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in training sequences."""
    prepare(spark)
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

# Models, sketches and tokens cannot be put in SQL: tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
