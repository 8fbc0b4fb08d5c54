"""Publish curated tables: every table is staged and verified before the manifest names it.

A publication writes each table to a new version folder, reads it back, compares row count
and content digest, and appends one manifest batch at the end. Readers resolve a table
through the manifest, so they see either the previous publication or the complete new one;
nothing is renamed, which also suits object stores. The files of a publication are listed with
their sizes and digests, so a swapped file is found without reading it as a table. :func:`expire` removes
what no reader needs any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.digest import content_digest
from ledgerlake.operators import quality

# Manifest folder and layout.
MANIFEST, FILES = "_manifest", "_files"
FILE_SCHEMA = "run_id STRING, table STRING, path STRING, n_bytes BIGINT, md5 STRING"
MANIFEST_SCHEMA = (
    "run_id STRING, published_at TIMESTAMP, table STRING, path STRING, n_rows BIGINT, digest DECIMAL(38,0)"
)


class PublishError(RuntimeError):
    """What was written is not what was meant to be published."""


def fingerprint(rows: DataFrame, table: str) -> DataFrame:
    """``table, n_rows, digest`` of a table, independent of row order and files."""
    return rows.agg(F.count("*").alias("n_rows"), content_digest(rows.columns).alias("digest")).select(
        F.lit(table).alias("table"), "n_rows", "digest"
    )


def file_fingerprints(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``table, path, n_bytes, md5`` of every Parquet file of a table, by its bytes (files of up to 2 GB)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select(F.lit(table).alias("table"), "path", F.col("length").alias("n_bytes"), F.md5("content").alias("md5"))


def publish(tables: Mapping[str, DataFrame], root: str, run_id: str | None = None) -> str:
    """Publish all tables or none; returns the run id."""
    run_id = run_id or uuid.uuid4().hex
    entries = []
    published_at = datetime.now(timezone.utc)
    spark = next(iter(tables.values())).sparkSession
    for name, rows in tables.items():
        path = f"{root}/{name}/run={run_id}"
        written = Observation()
        rows.observe(
            written, F.count(F.lit(1)).alias("n_rows"), content_digest(rows.columns).alias("digest")
        ).write.mode("errorifexists").parquet(path)
        stored = fingerprint(spark.read.schema(rows.schema).parquet(path), name).first()
        meant = written.get
        if meant["n_rows"] == 0:
            raise PublishError(f"{name}: the table is empty")
        if (stored["n_rows"], stored["digest"]) != (meant["n_rows"], meant["digest"]):
            raise PublishError(
                f"{name}: stored {stored['n_rows']} rows, digest {stored['digest']}; "
                f"expected {meant['n_rows']} rows, digest {meant['digest']}"
            )
        entries.append((run_id, published_at, name, path, stored["n_rows"], stored["digest"]))
    listed = [file_fingerprints(spark, entry[3], entry[2]).select(F.lit(run_id).alias("run_id"), "*") for entry in entries]
    # An exchange, not coalesce: files are read and hashed by many tasks, one task writes the short list.
    quality.all_problems(listed).repartition(1).write.mode("append").json(f"{root}/{FILES}")
    manifest = spark.createDataFrame(entries, MANIFEST_SCHEMA)
    manifest.coalesce(1).write.mode("append").json(f"{root}/{MANIFEST}")
    return run_id


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """All manifest lines; an expiry that was cut short may have left some twice."""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/{MANIFEST}").dropDuplicates(["run_id", "table"])


def latest_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Manifest lines of the last publication."""
    manifest = _manifest(spark, root)
    last = manifest.agg(F.max_by("run_id", F.struct("published_at", "run_id")).alias("run_id"))
    return manifest.join(last, "run_id", "left_semi")


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as of the last complete publication."""
    line = latest_manifest(spark, root).filter(F.col("table") == table).first()
    if line is None:
        raise PublishError(f"{table} has not been published")
    return spark.read.parquet(line["path"])


def verify_published(spark: SparkSession, root: str) -> DataFrame:
    """Problems of published tables whose content no longer matches the manifest."""
    parts = []
    for line in latest_manifest(spark, root).collect():  # one line per table
        stored = fingerprint(spark.read.parquet(line["path"]), line["table"])
        n_rows, digest = F.lit(line["n_rows"]), F.lit(line["digest"]).cast("decimal(38,0)")
        bad = stored.filter((F.col("n_rows") != n_rows) | (F.col("digest") != digest))
        detail = F.concat(
            F.lit("stored "), F.col("n_rows").cast("string"),
            F.lit(f" rows, the manifest says {line['n_rows']}, or another content"),
        )
        parts.append(quality.problems(bad, "published", line["table"], F.lit("content"), detail))
    if not parts:
        return spark.createDataFrame([], quality.PROBLEM)
    return quality.all_problems(parts)


def file_problems(spark: SparkSession, root: str) -> DataFrame:
    """Files of the last publication that are missing, are new, or have other bytes than when they were listed."""
    lines = latest_manifest(spark, root).select("run_id", "table", F.col("path").alias("folder")).collect()  # one per table
    if not lines:
        return spark.createDataFrame([], quality.PROBLEM)
    listed = spark.read.schema(FILE_SCHEMA).json(f"{root}/{FILES}").filter(F.col("run_id") == lines[0].run_id).dropDuplicates(["path"])
    found = quality.all_problems([file_fingerprints(spark, line.folder, line.table) for line in lines])
    was, now = listed.drop("run_id").alias("was"), found.alias("now")
    both = was.join(now, F.col("was.path") == F.col("now.path"), "full_outer")
    detail = (
        F.when(F.col("now.path").isNull(), F.lit("file is missing"))
        .when(F.col("was.path").isNull(), F.lit("file is not listed"))
        .when(F.col("was.n_bytes") != F.col("now.n_bytes"), F.lit("file has another size"))
        .when(F.col("was.md5") != F.col("now.md5"), F.lit("file has other bytes"))
    )
    return both.select(
        F.lit("published file").alias("check"), F.coalesce("was.table", "now.table").alias("table"),
        F.coalesce("was.path", "now.path").alias("key"), detail.alias("detail"),
    ).filter(F.col("detail").isNotNull())


def _rewritten(spark: SparkSession, folder: str, lines: DataFrame) -> None:
    """Put all lines of a list into one file; a reader in between sees some of them twice, never fewer."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before = [status.getPath() for status in store.listStatus(path)]
    kept = lines.collect()  # a line per table, or file, of the runs that are kept
    spark.createDataFrame(kept, lines.schema).coalesce(1).write.mode("append").json(folder)
    for old in before:
        if not old.getName().startswith("_"):
            store.delete(old, False)


def expire(spark: SparkSession, root: str, keep: int = 2, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Remove publications but the last ``keep``, if they are older than that; returns their run ids.

    The lines of the manifest go first and are put into one file, then the folders, so a reader that resolves a table always finds its
    files; one that resolved it earlier has ``older_than`` to finish.
    """
    manifest = _manifest(spark, root)
    runs = manifest.groupBy("run_id").agg(F.max("published_at").alias("at")).orderBy(F.desc("at"), F.desc("run_id")).collect()
    before = datetime.now(timezone.utc) - older_than
    old = [r.run_id for r in runs[max(keep, 1):] if r.at.replace(tzinfo=r.at.tzinfo or timezone.utc) <= before]
    if not old:
        return []
    folders = [r.path for r in manifest.filter(F.col("run_id").isin(old)).select("path").collect()]
    _rewritten(spark, f"{root}/{MANIFEST}", manifest.filter(~F.col("run_id").isin(old)))
    files = spark.read.schema(FILE_SCHEMA).json(f"{root}/{FILES}").dropDuplicates(["run_id", "path"])
    _rewritten(spark, f"{root}/{FILES}", files.filter(~F.col("run_id").isin(old)))
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return sorted(old)


def plan(spark: SparkSession, folder: str, tables: Mapping[str, str]) -> DataFrame:
    """What a publication would copy: ``table, target, n_rows, n_files, n_bytes``.

    ``tables`` maps a table to its target. Rows are counted from the footers of the files; no column is read.
    """
    nothing = F.lit(0).cast("bigint")

    def parts(name: str) -> list[DataFrame]:
        path = f"{folder}/{name}"
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
        return [
            spark.read.parquet(path).agg(F.count("*").alias("n_rows")).select("n_rows", nothing.alias("n_files"), nothing.alias("n_bytes")),
            files.agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")).select(nothing.alias("n_rows"), "n_files", "n_bytes"),
        ]

    listed = [part.select(F.lit(name).alias("table"), F.lit(target).alias("target"), "*") for name, target in tables.items() for part in parts(name)]
    figures = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "n_files", "n_bytes")]
    return quality.all_problems(listed).groupBy("table", "target").agg(*figures)
