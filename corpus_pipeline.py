"""From raw documents to training sequences: filter, deduplicate, mix, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import curriculum, packing, passages, quality, simhash
from tillbook.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes of texts that meet in a batch for a Python worker. By default it is sixteen times as much, and lists, joins and
#: copies of a batch make several times that in each worker of an executor.
BATCH_BYTES = "4m"


def _small_batches(spark: SparkSession) -> None:
    """Set for the session and left so, as a stage runs when its result is written."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, with what is known of their sites, does not reject."""
    _small_batches(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    _small_batches(spark)
    return simhash.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    _small_batches(spark)
    return passages.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return curriculum.curriculum(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequence and the offset each goes to."""
    _small_batches(spark)
    return packing.best_fit(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Suffix sorting, tokens and a trained classifier are beyond SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
