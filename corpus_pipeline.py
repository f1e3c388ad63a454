"""The corpus pipeline over ``documents``: every stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import crf_pii, jaccard_join, language_mixture, spaced_seeds, trie_bpe
from tarmac.llm.queries import table, tokenizer_path
from tarmac.llm.store import keep, setup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# SQL cannot express expectation-maximisation, a random field or BPE: the stages are tested against brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language (null, or no letter); ``lang`` becomes the predicted language."""
    predicted = language_mixture.add_language(docs)
    predicted = predicted.where(F.col("lang_pred") != language_mixture.UNKNOWN)
    return predicted.withColumn("lang", F.col("lang_pred")).drop("lang_pred", "lang_score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links of similarity 0.8 the one with the smallest doc_id stays."""
    return jaccard_join.one_per_component(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of ``benchmark``."""
    return spaced_seeds.without_benchmark(docs, table(spark, sf_dir, "benchmark")).drop("bad")


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by placeholders; ``n_chars`` follows the text."""
    return crf_pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as tokens: doc_id, lang, source, n_tokens, ids."""
    return trie_bpe.token_ids(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", no_benchmark),
    ("personal_data", no_personal_data),
    ("tokens", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the stored result of the one before."""
    docs = setup(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
