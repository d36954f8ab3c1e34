"""Text corpus from raw documents to packed sequences: the stages, each over all rows that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import bpe, language_id, packing, secrets_crf, simhash
from shopledger.llm.quality_rules import quality_rules
from shopledger.llm.tables import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rows(docs: DataFrame) -> DataFrame:
    """The whole row as the id that an operator passes on, and its text; so rows with equal or null ids stay apart."""
    return docs.select(F.struct(*COLUMNS).alias("row"), "text")


def _with_text(judged: DataFrame, changed: str) -> DataFrame:
    """The columns of documents, with the text in column `changed` where there is one."""
    text = F.coalesce(changed, "row.text")
    n_chars = F.when(F.col(changed).isNull(), F.col("row.n_chars")).otherwise(F.length(changed).cast("long"))
    return judged.select("row.doc_id", text.alias("text"), "row.lang", "row.source", n_chars.alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail them."""
    kept = quality_rules(_rows(docs), id_col="row").filter("kept").withColumnRenamed("doc_id", "row")
    return _with_text(kept.withColumn("clean", F.when(F.col("n_lines_removed") > 0, F.col("clean_text"))), "clean")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    found = language_id.identify(_rows(docs), language_id.train(docs), id_col="row")
    return found.filter("NOT rejected").select("doc_id.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs.select(*COLUMNS), shingle=3, max_bits=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets blacked out."""
    found = secrets_crf.scan(_rows(docs), secrets_crf.train(docs), id_col="row")
    return _with_text(found.withColumnRenamed("doc_id", "row"), "redacted")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: sequence, offset and the sequence's length, in byte-level BPE ids with
    an end mark for each document."""
    return packing.pack(bpe.token_counts(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scans", secrets),
    ("best_fit_packing", sequences),
]

#: The stages train models, hash and pack greedily, which SQL can't express; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's rows written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
