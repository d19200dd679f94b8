"""A training-data pipeline: five operators of ``tickerloom.llm``, each stage written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import language_id, mixing, packing, secret_scan, simhash
from tickerloom.llm.common import materialise, table
from tickerloom.llm.queries import tokenizer_path
from tickerloom.session import scratch_dir, scratch_scope
from tickerloom.sinks import storage


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: some letter, and no near-even split between languages."""
    return language_id.accepted(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked within 3 bits: the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the secret scan reports replaced."""
    return secret_scan.mask(docs, F.col("doc_id"), F.col("source"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language identification", identified),
    ("SimHash near-dedup", deduplicated),
    ("secret scans", masked),
    ("mixing", mixed),
    ("packing", packed),
]

#: A trained model, XXH64 and a tokenizer have no SQL; the tests hold ``run`` against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. What a stage wrote on the way goes once its result is written, its input too.

    The rows returned read the last input and packing's own tables: a caller that has written them can leave
    an enclosing ``scratch_scope``, which deletes those.
    """
    docs, kept = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        read, kept = kept, scratch_dir(spark)
        with scratch_scope(spark):
            docs = materialise(stage(spark, docs, sf_dir), kept)
        if read is not None:
            storage.delete(spark, read)
    return STAGES[-1][1](spark, docs, sf_dir)
