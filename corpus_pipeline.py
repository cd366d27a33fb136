"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes the rows that the one before kept, decides with one operator and returns
the rows that stay, with the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom import session
from orderloom.llm import common, decontamination, exact_dedup, language_id, ngram_join, packing

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without any letter go."""
    common.prepare(spark)
    return language_id.accepted(docs, language_id.train(docs))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a Jaccard similarity of 0.8, one stays."""
    return ngram_join.drop_near_duplicates(docs, width=5, percent=80)


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no stretch of a benchmark item."""
    return decontamination.clean_documents(docs, common.read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids placed in sequences of 1024."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_benchmark_text),
    ("packing", pack_sequences),
]

#: SQL cannot tokenise or fit a classifier; tests/llm/test_pipeline.py checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows stored before the next reads them.

    What a stage stored for itself is removed when its rows are written, and those rows when
    the next stage's are.
    """
    docs = common.read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = session.scratch_path(spark, f"pipeline-{name}")
        with session.scratch_scope(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before:
            session.remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
