"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from larder.llm import conversations, language, mixing, quality, repeats, secrets, sharding, toxicity
from larder.llm.common import prepare, documents, fold
from larder.llm.exact_dedup import copy_groups
from larder.llm.html_text import extract
from larder.llm.near_dedup import near_duplicates
from larder.llm.packing import pack
from larder.llm.phrases import collocations
from larder.llm.vocabulary import tokenizer_file


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_file())


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = toxicity.score(docs, toxicity.train(docs, labels, fold() != 1))
    return found.select("doc_id", (fold() == 1).alias("held_out"), "score", "predicted")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir)).drop("row_number")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir)))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predict(docs, language.train(docs, fold() != 1))
    return found.select("doc_id", (fold() == 1).alias("held_out"), "lang_pred", "score")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), similarity=0.85).drop("text_hash")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.summaries(conversations.damaged(rows), rows)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": pipeline,
    "op1_packing": op1_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_secrets": op6_secrets,
    "op7_html_text": op7_html_text,
    "op8_language_id": op8_language_id,
    "op9_mixing": op9_mixing,
    "op10_near_dedup": op10_near_dedup,
    "op11_conversations": op11_conversations,
    "op12_collocations": op12_collocations,
    "op13_repeats": op13_repeats,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (same ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op3_quality": quality.ORACLE,
}
