"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    centroid_clusters,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    part_codes,
    quality_rules,
    secret_scan,
    string_tiling,
    token_shards,
    toxic_spans,
    url_rules,
    warc,
)
from ledgerlake.sources.tables import read_table


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents.parquet")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, and those removed since an earlier line is nearly equal."""
    return line_dedup.summarise(_documents(spark, folder))


def quality(spark: SparkSession, folder: str) -> DataFrame:
    """Figures and verdict of every document."""
    return quality_rules.assess(_documents(spark, folder))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, whether test items contaminate it, and which."""
    return string_tiling.judge(_documents(spark, folder), read_table(spark, folder, "benchmark.parquet"))


def urls(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page by given rules and by rules mined from labels.

    The number in a page's path names the document that the page shows, whose labels are the page's:
    a toxic or poor document is one to block.
    """
    pages = read_table(spark, folder, "pages.parquet").select("page_id", "url")
    bad = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int"))
    labels = read_table(spark, folder, "labels.parquet").groupBy("doc_id").agg(bad.alias("bad"))
    _, path = url_rules.host_and_path(F.col("url"))
    number = F.try_to_number(F.regexp_extract(path, "/([0-9]{1,18})", 1), F.lit("9" * 18)).cast("long")
    labelled = pages.select("url", number.alias("doc_id")).join(labels, "doc_id")
    verdict = F.when(F.col("bad") == 1, url_rules.BLOCK).when(F.col("bad") == 0, url_rules.ALLOW)
    return url_rules.judge(pages, labelled.select("url", verdict.alias("label")))


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to web archives and read back."""
    planned = warc.plan_records(read_table(spark, folder, "pages.parquet"), least_revisit=1000)
    written = warc.write_archives(planned, warc.shared_uri(spark, "archives"))
    records = warc.read_archives(written, payloads=False)
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def licences(spark: SparkSession, folder: str) -> DataFrame:
    """Words, base phrases, licence labels and score of every document."""
    return license_scan.scan(_documents(spark, folder))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, digest and spans of the secrets of every document."""
    found = secret_scan.scan(_documents(spark, folder))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy")


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of every document in the mixture of the target weights, and what it rests on."""
    fitted, scored = mixing.fit_mixture(_documents(spark, folder), read_table(spark, folder, "labels.parquet"))
    posterior = [F.get("posterior", F.lit(k)).alias(f"p_{name}") for k, name in enumerate(mixing.DOMAINS)]
    return mixing.with_rates(scored, fitted).select("doc_id", "n_tokens", *posterior, "rate")


def ngram_components(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share nine tenths of their three-word shingles."""
    return ngram_join.near_copies(_documents(spark, folder), ngram_join.Join(size=3, percent=90))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every sequence of the training order with its slot, place, checksum and documents."""
    index = token_shards.with_slots(token_shards.write_shards(_documents(spark, folder)))
    return index.select("slot", "shard", "position", "n_tokens", "crc32", "doc_ids")


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score, verdict and offending spans of every document."""
    return toxic_spans.judge(_documents(spark, folder), read_table(spark, folder, "labels.parquet"))


def clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster and distance of every embedding of 64 components, inertias and centroid digests."""
    return centroid_clusters.summarise(read_table(spark, folder, "embeddings.parquet"))


def codes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every embedding, the error of its label and the digest of the codebooks."""
    return part_codes.summarise(read_table(spark, folder, "embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": lines,
    "op2_quality_rules": quality,
    "op3_decontamination": decontamination,
    "op4_url_filter": urls,
    "op5_warc": archives,
    "op6_license_scan": licences,
    "op7_secret_scan": secrets,
    "op8_mixing": mixture,
    "op9_ngram_join": ngram_components,
    "op10_token_shards": shards,
    "op11_toxicity": toxicity,
    "op12_centroid_clusters": clusters,
    "op13_part_codes": codes,
}
