"""A corpus from documents: rules, exact and near duplicates, mix, sampled segmentations.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; the runner writes it and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.llm import adaptive_rules, lattice_sampling, mixing, partenum, perfect_dedup
from stardw.llm.tables import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the cutoffs of their language and source."""
    return adaptive_rules.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return perfect_dedup.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.75 or more the one with the smallest id."""
    return partenum.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source reads it."""
    return mixing.materialised(docs)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every row, with their ids."""
    return lattice_sampling.encoded(docs).select(
        F.col("key").alias("doc_id"), "sample", "ids", "log_prob", "log_inclusion",
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("segmentations", segmentations),
]

# Sampled segmentations and quantile sketches are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, applied to the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
