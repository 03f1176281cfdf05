"""Training-data pipeline over ``documents``: five stages, each one operator's work.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.llm import decontamination, exact_dedup, pieces, quality, simhash
from ledgerwatch.llm.common import read_table, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.3 or more)."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The owner of every distinct text."""
    return exact_dedup.survivors(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (3-word shingles, 3 bits)."""
    return simhash.survivors(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether they decode to its text."""
    return pieces.round_trip(docs, pieces.Model(spark))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("pieces", pieces_stage),
]

#: A trained model, 64-bit hashes and a Viterbi search cannot be stated in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
