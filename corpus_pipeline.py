"""Corpus cleaning: toxicity, quality, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of their input. ``run`` writes each result as Parquet in the shared folder and rereads
it as the next stage's documents. Null ids, null and empty texts, repeated rows, empty tables and
extra columns pass through each stage as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filegate.llm.contamination import drop_contaminated
from filegate.llm.neardup import drop_near_duplicates
from filegate.llm.packing import pack
from filegate.llm.resampling import keep_selected
from filegate.llm.staging import ship, stage, table
from filegate.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    ship(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the labelled good ones selects."""
    ship(spark)
    return keep_selected(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each component of near duplicates (five words, 0.8)."""
    ship(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty stand in benchmark windows."""
    ship(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed bins."""
    ship(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifiers, the forest and best fit have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
