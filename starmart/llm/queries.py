"""One query per operator over the whole ``documents`` table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    classify,
    conversations,
    fingerprints,
    lexical,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    packing,
    quality_rules,
    substring,
    suffix_dedup,
    toxicity,
)
from starmart.llm.oracle import SQL
from starmart.llm.tables import documents


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids; one row per piece of a document."""
    return packing.pack(documents(spark, sf_dir), keep_ids=False)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices found in each text."""
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and adaptive thresholds per language and source."""
    rows = quality_rules.apply_rules(documents(spark, sf_dir))
    return rows.withColumn("failed_rules", F.array_join("failed_rules", ","))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after removing repeated three-line windows."""
    rows = line_dedup.dedup_lines(documents(spark, sf_dir, "doc_id", "text"))
    return rows.select("doc.doc_id", "n_lines", "n_removed",
                       F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("kept_sha256"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document with a smaller id holds as well."""
    return suffix_dedup.repeated_passages(documents(spark, sf_dir))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    rows = classify.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.drop("text_key")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of every text and of its edited text."""
    return fingerprints.fingerprints(documents(spark, sf_dir)).drop("wide", "lanes")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose two-word shingle sets are at least 80 % alike."""
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=2, percent=80)


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing passages that start in a smaller document as well."""
    return substring.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents of highest score for each benchmark item."""
    return lexical.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation after seeded damage."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair(conversations.damage(rows)).withColumnRenamed("conv", "conv_id")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text."""
    rows = toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.drop("text_key")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pack, op2_licenses, op3_quality_rules, op4_line_dedup, op5_suffix_dedup,
                            op6_quality_classifier, op7_fingerprints, op8_near_dedup, op9_mix,
                            op10_substring_dedup, op11_lexical_search, op12_conversation_repair,
                            op13_toxicity)}

__all__ = ["REGISTRY", "SQL"]
