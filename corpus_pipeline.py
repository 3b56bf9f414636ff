"""A training corpus from ``documents``: five stages, each over all rows that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placetally.llm import decontamination, mixing, simhash, substring_dedup, toxicity
from placetally.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled documents of the input, scores below 0.5."""
    model = toxicity.fit_on(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints of three-word shingles that differ in at most 3 bits.

    It is the one with the smallest doc_id; documents without a doc_id stay.
    """
    return simhash.keep_first(docs, shingle=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word sequences that a document with a smaller doc_id has; empty ones go."""
    return substring_dedup.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no 10-word window of a benchmark item occurs."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (``copy`` counts from 1), by the weights of their sources."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", first_of_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each stored as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
