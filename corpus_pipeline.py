"""A corpus pipeline of stages, each reading the Parquet that the one before it wrote.

Quality rules drop documents, SimHash keeps one document of each near-duplicate group, repeated passages
are cut from all documents but the first that has them, secrets are replaced by a mark, and what is left
is packed into training sequences. All stages but the last return the columns of ``documents``.

Defined cases are those of the operators: null texts fail the quality rules, an empty table stays empty
through all stages, and further columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewrank.llm import packing, passages, quality_rules, secrets, simhash
from reviewrank.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each SimHash group."""
    return simhash.one_of_each_group(docs, words_in_shingle=3, most_bits=3)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    return passages.without_repeats(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark."""
    return secrets.redacted(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in the training sequences."""
    return packing.packed_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeats),
    ("secret_scan", redaction),
    ("best_fit_packing", sequences),
]
#: Chaining, tokenizing and packing have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to the table ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERY = run
