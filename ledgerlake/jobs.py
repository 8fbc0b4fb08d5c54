"""Command line of the finance lake, one job per layer.

    python -m ledgerlake.jobs land --lake <folder> --servers <brokers> --prefix <topics.>
    python -m ledgerlake.jobs daily --lake <folder> --messages <folder> --prefix <topics.> [--force]
    python -m ledgerlake.jobs backlog --lake <folder> --available <json> --prefix <topics.>
    python -m ledgerlake.jobs compact --lake <folder>

or ``spark-submit ledgerlake/jobs.py …`` with the package on the Python path.

Exit codes: 0 done, 1 a gate or a verification failed, 99 nothing to do (not configured, or no message
since the last complete run), so that a scheduler can mark the step as skipped. The load reads what has been published.
"""

from __future__ import annotations

import argparse
import re
import sys
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import SparkSession

from ledgerlake.operators import changes, outliers, reports
from ledgerlake.operators.backlog import offset_backlog
from ledgerlake.operators.quality import QualityError, gate
from ledgerlake.plans import finance
from ledgerlake.plans.steps import run_steps
from ledgerlake.session import apply_sql_defaults, build_session
from ledgerlake.sinks import publish, warehouse
from ledgerlake.sources import events
from ledgerlake.sources.relational import JdbcSource, ParquetSource
from ledgerlake.streaming import landing, progress

DONE, FAILED, SKIPPED = 0, 1, 99
LAYERS = ("state", "curated", "outliers", "publish")


def parser() -> argparse.ArgumentParser:
    jobs = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs.add_argument("job", choices=["land", "daily", "backlog", "compact", *LAYERS, "load", "reconcile", "expire", "plan", "profile", "summary"])
    jobs.add_argument("--lake", required=True, help="folder of the layers")
    jobs.add_argument("--published", default="", help="folder of the published tables")
    jobs.add_argument("--dataset", default="", help="warehouse data set of the load")
    jobs.add_argument("--prefix", default="", help="topic prefix, up to and including the last dot")
    jobs.add_argument("--servers", default="", help="Kafka brokers")
    jobs.add_argument("--messages", default="", help="folder of message files, instead of brokers")
    jobs.add_argument("--max-offsets", type=int, default=None, help="most messages of a batch, from brokers")
    jobs.add_argument("--min-partitions", type=int, default=None, help="fewest tasks of a batch, from brokers")
    jobs.add_argument("--available", default="", help="JSON lines of topic, partition, next_offset: the ends of the topics")
    jobs.add_argument("--segments", action="store_true", help="land batches that can be compacted")
    jobs.add_argument("--source", default="", help="source database (JDBC address) or a folder of its tables as Parquet")
    jobs.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE", help="option of the JDBC reader")
    jobs.add_argument("--keep", type=int, default=2, help="publications that stay, whatever their age")
    jobs.add_argument("--days", type=float, default=7, help="age below which a publication stays")
    jobs.add_argument("--force", action="store_true", help="rebuild although nothing has landed")
    jobs.add_argument("--master", default=None)
    return jobs


def lake_of(args: argparse.Namespace) -> finance.Lake:
    folder = args.lake.rstrip("/")
    return finance.Lake(
        raw=f"{folder}/raw",
        checkpoint=f"{folder}/checkpoints/raw",
        state=f"{folder}/state",
        curated=f"{folder}/curated",
        published=args.published or f"{folder}/published",
    )


def _messages(spark: SparkSession, args: argparse.Namespace):
    if args.messages:
        return events.file_events(spark, args.messages)
    if args.servers:
        return events.kafka_events(
            spark, args.servers, re.escape(args.prefix) + ".*",
            max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions,
        )
    return None


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one job in a session; returns the exit code."""
    lake = lake_of(args)
    if args.job in ("land", "daily"):
        stream = _messages(spark, args)
        if stream is None:
            print("neither --servers nor --messages: nothing to land")
            return SKIPPED
        if args.job == "land":
            finance.land(stream, args.prefix, lake, args.segments)
        elif finance.daily_run(spark, lake, stream, args.prefix, args.force, args.segments) is None:
            print("no message since the last complete run")
            return SKIPPED
    elif args.job == "backlog":
        return _backlog(spark, lake, args)
    elif args.job == "compact":
        name, expired = finance.compact_raw(spark, lake)
        print(f"compacted into {name}" if name else "nothing to compact", *expired)
        return DONE if name or expired else SKIPPED
    elif args.job in LAYERS:
        if args.job == "publish" and not args.published:
            print("no --published: publication is skipped")
            return SKIPPED
        run_steps(step for step in finance.batch_steps(spark, lake) if step.name == args.job)
    elif args.job == "load":
        if not args.dataset:
            print("no --dataset: the load is skipped")
            return SKIPPED
        tables = {name: publish.read_published(spark, lake.published, name) for name in finance.CURATED}
        print(warehouse.load_tables(spark, tables, finance.CURATED, args.dataset))
        gate(warehouse.loaded_problems(spark, tables, finance.CURATED, args.dataset))
    elif args.job == "reconcile":
        if not args.source:
            print("no --source: nothing to compare with")
            return SKIPPED
        gate(finance.source_problems(*_layers(spark, lake), _source(spark, args)))
    elif args.job == "expire":
        gone = publish.expire(spark, lake.published, args.keep, timedelta(days=args.days))
        print(*gone or ["nothing to expire"])
        return DONE if gone else SKIPPED
    elif args.job == "plan":
        targets = {name: f"{lake.published}/{name}" for name in finance.CURATED}
        publish.plan(spark, lake.curated, targets).show(truncate=False)
    elif args.job == "profile":
        profile = changes.raw_profile(finance.raw_log(spark, lake))
        for row in profile.orderBy("scope", "table", "ingest_date").toLocalIterator():
            print(*row, sep="\t")
    else:
        _summary(spark, lake)
    return DONE


def _layers(spark: SparkSession, lake: finance.Lake):
    return finance.read_layer(spark, lake.curated, finance.CURATED), finance.read_layer(spark, lake.state, finance.SOURCE)


def _source(spark: SparkSession, args: argparse.Namespace) -> JdbcSource | ParquetSource:
    if args.source.startswith("jdbc:"):
        options = dict(option.split("=", 1) for option in args.source_option)
        return JdbcSource(spark, args.source, tuple(finance.SOURCE), options)
    return ParquetSource(spark, args.source, tuple(finance.SOURCE))


def _backlog(spark: SparkSession, lake: finance.Lake, args: argparse.Namespace) -> int:
    """Messages per topic and partition that no committed batch covers."""
    if not args.available:
        print("no --available: nothing to compare with")
        return SKIPPED
    available = spark.read.schema("topic string, partition int, next_offset bigint").json(args.available)
    landed = progress.committed_offsets(spark, lake.checkpoint)
    pending = offset_backlog(available, landed, landing.topic_pattern(args.prefix)).orderBy("topic", "partition")
    waiting = False
    for row in pending.toLocalIterator():
        waiting = True
        print(*row, sep="\t")
    return DONE if waiting else SKIPPED


def _summary(spark: SparkSession, lake: finance.Lake) -> None:
    """A screen of each: where outliers concentrate, the largest of them, the owners' last months."""
    tables = finance.read_layer(spark, lake.curated, finance.CURATED)
    found = tables["anomalias"]
    outliers.hotspots(found, ["usuario_id", "destino"], 8).show(truncate=False)
    largest = found.withColumnsRenamed({"exceso_sobre_limite": "excess"})
    reports.top_outliers(largest, "egreso_id", 10).show(truncate=False)
    reports.latest_periods(tables["balance_mensual"], "usuario_id", "mes", 6).orderBy("usuario_id", "mes").show()


def main(arguments: Sequence[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    active = SparkSession.getActiveSession()
    spark = apply_sql_defaults(active) if active else build_session(f"ledgerlake-{args.job}", args.master)
    try:
        return run(spark, args)
    except (QualityError, publish.PublishError, warehouse.LoadError) as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return FAILED


if __name__ == "__main__":
    sys.exit(main())
