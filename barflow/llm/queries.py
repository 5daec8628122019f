"""The named queries of these operators; each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import (
    bitplane, conversations, decontaminate, hard_negatives, licenses, mixing, near_dup, packing, quality, secret_scan,
    sharding, topk, url_rules,
)
from barflow.llm.common import prepare, read

#: The rules (host, path, verdict) of the URL query.
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_license_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and covered licence passages of every document."""
    return licenses.scan(read(spark, folder, "documents").select("doc_id", "text")).drop("spans")


def op2_pack_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document, packed into sequences of at most 2048 ids."""
    return packing.pack(read(spark, folder, "documents").select("doc_id", "text"))


def op3_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: fixed patterns and random tokens."""
    return secret_scan.find(read(spark, folder, "documents").select("doc_id", "text"))


def op4_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL: blocked or allowed by the longest rule, allowed without one."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = read(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_shard_table(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document."""
    documents = read(spark, folder, "documents").select("doc_id")
    return sharding.place(documents, "doc_id")


def op6_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or as a paraphrase."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.find(documents, read(spark, folder, "benchmark"))


def op7_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return quality.score(documents, read(spark, folder, "labels").select("doc_id", "quality"))


def op8_id_planes(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of all documents, written in planes and read back."""
    return bitplane.encode_and_read(read(spark, folder, "documents").select("doc_id", "text"))


def op9_threshold_top5(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors, by whole-number inner product, of every fiftieth vector."""
    embeddings = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.search(embeddings, F.col("vec_id") % 50 == 0)


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near duplicates of every document, and whether the document stays."""
    return near_dup.groups(read(spark, folder, "documents").select("doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten hard negatives for each of the five positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = read(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(embeddings, F.col("vec_id") % 100 == 0)


def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.shares(read(spark, folder, "documents").select("doc_id", "source", "text"))


def op13_repaired_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return conversations.repaired(read(spark, folder, "conversations"), conversations.damage_kind())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_license_spans, op2_pack_windows, op3_secret_spans, op4_url_rules, op5_shard_table,
        op6_benchmark_leaks, op7_quality_scores, op8_id_planes, op9_threshold_top5, op10_near_duplicates,
        op11_hard_negatives, op12_source_mix, op13_repaired_conversations,
    ]
    return {f.__name__: (lambda s, d, f=f: f(prepare(s), d)) for f in named}
