"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import (
    crf_pii,
    hard_negatives,
    jaccard_join,
    kneser_ney,
    language_mixture,
    passages,
    quartile_digest,
    secret_owners,
    spaced_seeds,
    spelling_variants,
    token_counts,
    tool_links,
    trie_bpe,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


@query
def op1_quartile_digest(spark: SparkSession, d: str) -> DataFrame:
    return quartile_digest.compare_with_next(table(spark, d, "documents"))


@query
def op4_trie_bpe(spark: SparkSession, d: str) -> DataFrame:
    return trie_bpe.encode_documents(table(spark, d, "documents"), tokenizer_path())


@query
def op7_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, d, "documents"))


@query
def op10_kneser_ney(spark: SparkSession, d: str) -> DataFrame:
    return kneser_ney.score_documents(table(spark, d, "documents"))


@query
def op6_spaced_seeds(spark: SparkSession, d: str) -> DataFrame:
    return spaced_seeds.benchmark_overlaps(table(spark, d, "documents"), table(spark, d, "benchmark"), whole=True)


@query
def op9_language_mixture(spark: SparkSession, d: str) -> DataFrame:
    return language_mixture.predict_languages(table(spark, d, "documents"))


@query
def op3_crf_pii(spark: SparkSession, d: str) -> DataFrame:
    return crf_pii.personal_data(table(spark, d, "documents"))


@query
def op5_tool_links(spark: SparkSession, d: str) -> DataFrame:
    calls, results = tool_links.calls_of(table(spark, d, "conversations"))
    return tool_links.link_tools(calls, results, tool_links.tools(spark))


@query
def op8_secret_owners(spark: SparkSession, d: str) -> DataFrame:
    return secret_owners.owned_secrets(table(spark, d, "documents"))


@query
def op2_passages(spark: SparkSession, d: str) -> DataFrame:
    return passages.repeated_passages(table(spark, d, "documents"))


@query
def op11_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, d, "documents"), tokenizer_path())


@query
def op12_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, d, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    return hard_negatives.mine(table(spark, d, "embeddings"))


ORACLE["op13_hard_negatives"] = hard_negatives.ORACLE
