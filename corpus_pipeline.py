"""The corpus pipeline: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bloomline.llm import decontamination, packing, quality_classifier, simhash, substring_dedup
from bloomline.llm.queries import table, vocabulary
from bloomline.llm.shipping import ship
from bloomline.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship(spark)
    return quality_classifier.score_quality(docs, table(spark, sf_dir, "labels"), keep=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    ship(spark)
    return simhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; one that is left empty goes."""
    ship(spark)
    return substring_dedup.remove_passages(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    ship(spark)
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces and their places in training sequences."""
    ship(spark)
    return packing.pack_sequences(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality), ("SimHash near-dedup", near_duplicates), ("substring dedup", passages),
    ("benchmark decontamination", benchmark), ("best-fit packing", sequences),
]

#: Training by gradient descent and similarity by hashing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
