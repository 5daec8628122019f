"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``; the last returns the pieces of documents in their sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barflow.llm import decontaminate, near_dup, packing, quality, secret_scan
from barflow.llm.common import discard, prepare, read, scratch, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for bad go; it learns from the table ``labels``."""
    return quality.keep_good(docs, read(prepare(spark, lean=True), sf_dir, "labels").select("doc_id", "quality"))


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    prepare(spark, lean=True)
    return near_dup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an item of the table ``benchmark`` go."""
    return decontaminate.drop_leaks(docs, read(prepare(spark, lean=True), sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mask."""
    prepare(spark, lean=True)
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences of at most 2048 ids."""
    prepare(spark, lean=True)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good_text),
    ("near_duplicates", keep_one_of_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", hide_secrets),
    ("packing", pack_sequences),
]

#: A trained classifier, a vocabulary and a latent space are no SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``. What a stage has written goes once the next one is."""
    docs = read(prepare(spark, lean=True), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch() as keep:
            after = keep(stored(stage(spark, docs, sf_dir), name))
        discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
