"""From raw documents to training shards: clean, deduplicate, decontaminate, mix, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import mixing, ngram_join, quality_rules, string_tiling, token_shards
from ledgerlake.llm.common import materialise
from ledgerlake.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.clean(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8."""
    return ngram_join.keep_one(docs, ngram_join.Join(size=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no test item."""
    return string_tiling.remove_contaminated(docs, read_table(spark, folder, "benchmark.parquet"))


def mixing_weights(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mixture of the target weights asks for."""
    fitted, _ = mixing.fit_mixture(docs, read_table(spark, folder, "labels.parquet"))
    return mixing.resample(docs, fitted)


def training_order(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Shards written; every sequence with its slot, place, checksum and documents."""
    index = token_shards.with_slots(token_shards.write_shards(docs))
    return index.select("slot", "shard", "position", "n_tokens", "crc32", "doc_ids")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing_weights),
    ("token shards", training_order),
]

# The join's components, greedy tilings, fitted rates and encoded shards can't be said in SQL;
# tests hold each stage against a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = read_table(spark, folder, "documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if number + 1 < len(STAGES):
            docs = materialise(docs, "stage")
    return docs
