"""The operators of this subpackage over the tables of a dataset folder, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filegate.llm.staging import table

TOKENIZER = "byte_bpe_50k.json"


def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.syncmers import compare_edited

    return compare_edited(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from filegate.llm.tokens import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.neardup import component_report

    return component_report(table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.warc import warc_round_trip

    return warc_round_trip(table(spark, sf_dir, "pages"))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.recurrent import score

    return score(table(spark, sf_dir, "documents"))


def op9_kdtree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.kdtree import kd_shards

    docs = table(spark, sf_dir, "documents")
    length = F.log2(F.length(F.coalesce("text", F.lit(""))) + 1.0)
    return kd_shards(docs, [length, "lang", "source", "doc_id"], shards=16)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.contamination import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.merkle import tamper_report

    return tamper_report(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.qualityrules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filegate.llm.fillmiddle import fill_report

    return fill_report(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the subpackage by name."""
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
