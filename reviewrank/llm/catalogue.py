"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewrank.llm import (
    bpe,
    conversations,
    divergence,
    language,
    packing,
    passage_quality,
    passages,
    quality_rules,
    secrets,
    simhash,
    urls,
    vectors,
    winnowing,
)
from reviewrank.llm.oracle import ORACLE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


VOCABULARY = "byte_bpe_50k.json"
#: Fixed values of the query: rules by host and path.
URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)
QUALITY_LEAST = 0.3
#: Words in a host that put a page's URL on the list.
LISTED_HOSTS = r"(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)"


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    listed = pages.where(urls.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return urls.judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op1_vectors(spark: SparkSession, folder: str) -> DataFrame:
    linked = vectors.linked_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return linked.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_rules.judge(docs).select("doc_id", *counts, "base_failed", "kept")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = language.remainder(F.col("doc_id"), 4) == 2
    known = language.dictionaries(docs.where(~held_out))
    return language.identify(docs, known).withColumn("held_out", held_out)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = language.remainder(F.col("doc_id"), 5) == 0
    model = passage_quality.train(docs, table(spark, folder, "labels").where(~held_out))
    scored = passage_quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def op10_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    of_kind = lambda k: F.size(F.filter("base_spans", lambda s: s["kind_no"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(of_kind(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])),
        F.sha2(secrets.as_text(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, folder, "conversations")))


def op12_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.edited_texts(table(spark, folder, "documents"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES = {
    "op1_vectors": op1_vectors,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_url_filter": op5_url_filter,
    "op6_language": op6_language,
    "op7_bpe": op7_bpe,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_passages": op10_passages,
    "op11_conversations": op11_conversations,
    "op12_winnowing": op12_winnowing,
    "op13_source_divergence": op13_source_divergence,
}

__all__ = ["ORACLE", "QUERIES"]
