"""The operators over their whole tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopledger.llm import (
    bit_codes,
    bpe,
    hard_negatives,
    html_text,
    language_id,
    oracle,
    packing,
    ranked_search,
    secrets_crf,
    token_files,
)
from shopledger.llm.quality_rules import quality_rules
from shopledger.llm.simhash import simhash_components
from shopledger.llm.superminhash import superminhash_components
from shopledger.llm.tables import fresh_path
from shopledger.llm.url_filter import UrlRule, judge_urls


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir)).drop("clean_text")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir))


def op3_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return secrets_crf.scan(docs, secrets_crf.train(docs)).drop("redacted")


def op4_bit_code_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_codes.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs))


def op6_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-ids")
    token_files.write(_documents(spark, sf_dir), path)
    return token_files.read_digests(spark, path)


#: Rules on hosts and path prefixes, with what they decide.
URL_RULES = [
    UrlRule("net/", "block"),
    UrlRule("example.net/en/", "allow"),
    UrlRule("example.com/de/", "block"),
    UrlRule("org/fr/", "allow"),
]


def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(bpe.token_counts(_documents(spark, sf_dir)))


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_documents(spark, sf_dir), shingle=3, max_bits=3)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_superminhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash_components(_documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_crf_secrets": op3_crf_secrets,
    "op4_bit_code_neighbours": op4_bit_code_neighbours,
    "op5_language_id": op5_language_id,
    "op6_token_id_files": op6_token_id_files,
    "op7_url_templates": op7_url_templates,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_simhash_components": op9_simhash_components,
    "op10_main_text": op10_main_text,
    "op11_superminhash_components": op11_superminhash_components,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ranked_search": op13_ranked_search,
}

#: The other queries train models, code, hash or pack greedily, which SQL can't express.
ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": oracle.QUALITY_RULES,
    "op4_bit_code_neighbours": oracle.NEIGHBOURS,
    "op12_hard_negatives": oracle.HARD_NEGATIVES,
    "op13_ranked_search": oracle.RANKED_SEARCH,
    "op7_url_templates": oracle.url_templates([(rule.pattern, rule.verdict) for rule in URL_RULES]),
}
