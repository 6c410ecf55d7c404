"""From raw documents to packed training sequences, stage by stage.

Each stage reads the table its predecessor wrote and works on all of it. All but the last
give the columns of documents, whatever other columns there are beside them.

Defined results: a null or empty text fails the quality rules and goes with its document;
null ids are documents like others, as are rows that share one; of rows equal in id and text
one stays; very long texts pass whole and are cut only by the mix and the packing; where
nothing is kept, or the table is empty, there are no sequences.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from regweave.llm import jaccard_join, mixing, packing, pii, quality
from regweave.llm.common import delete, passing_tables, scratch, small_batches, table
from regweave.llm.tokens import added_tokens


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with Python tasks that get few rows at a time."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return bounded


@in_small_batches
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return quality.keep_good(docs)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similar to 0.8)."""
    return jaccard_join.keep_one(docs)


@in_small_batches
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.mask(docs)


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The parts of documents that the mix of sources takes, a row each time."""
    return mixing.mixed(docs)


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the mixed parts."""
    return packing.pack(docs, added=added_tokens())


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned weights and pseudorandom draws have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is a table in the shared folder, which
    goes, with the tables its stage needed, once the next one has been written."""
    docs, held = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch(spark, f"stage{k}")
        with passing_tables(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if held:
            delete(spark, held)
        held = path
    return STAGES[-1][1](spark, docs, sf_dir)
