"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on: periods are counted in UTC, bad casts
# fail loudly, and AQE sizes shuffles and splits skewed join partitions.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Settings that only a new session can take: no call-site capture for every column
# expression, which is most of the driver time of building a large plan.
STATIC_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SQL_DEFAULTS, **STATIC_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_sql_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL defaults on a session somebody else created."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for streams and intermediate tables.

    It lives under ``spark.checkpoint.dir``, which a cluster points at storage that all
    executors share. Only a local master may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="ledgerlake-", dir="/tmp")
        shared = _LOCAL_SCRATCH[app]
    return os.path.join(shared, f"{name}-{uuid.uuid4().hex[:12]}")
