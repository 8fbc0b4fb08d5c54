"""Load curated tables into a warehouse catalogue: truncate, replace, verify."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import quality, reconcile
from ledgerlake.spec import TableSpec

# What a data set may be called.
DATASET_NAME = re.compile(r"^[A-Za-z0-9_]{1,1024}$")


class LoadError(RuntimeError):
    """A table did not arrive as the contract says."""


def load_plan(tables: Mapping[str, TableSpec], dataset: str) -> dict[str, str]:
    """Target of every table; rejects a bad data set name before anything is written."""
    if not DATASET_NAME.match(dataset):
        raise LoadError(f"{dataset!r} is not valid: letters, digits and underscores only")
    return {name: f"{dataset}.{name}" for name in tables}


def load_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    dataset: str,
    source: str = "parquet",
    **options: str,
) -> dict[str, int]:
    """Replace each warehouse table and verify its columns, types and row count.

    Decimals are pinned by the contract. Stops at the first failure, so that later tables
    stay as they were. ``source`` is any data source that can save a catalogue table.
    """
    targets = load_plan(specs, dataset)
    loaded = {}
    for name, rows in tables.items():
        spec, target = specs[name], targets[name]
        quality.gate(quality.contract_problems(spark, rows.schema, spec))
        written = Observation()
        (
            rows.select(*spec.columns)
            .observe(written, F.count(F.lit(1)).alias("n"))
            .write.mode("overwrite")
            .format(source)
            .options(**options)
            .saveAsTable(target)
        )
        stored = spark.table(target)
        quality.gate(quality.contract_problems(spark, stored.schema, spec))
        n = stored.count()
        if n != written.get["n"]:
            raise LoadError(f"{target}: has {n} rows, the load wrote {written.get['n']}")
        loaded[target] = n
    return loaded


def loaded_problems(
    spark: SparkSession, tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], dataset: str
) -> DataFrame:
    """What differs between the warehouse and the tables it was loaded from: columns, types and whole rows."""
    targets = load_plan(specs, dataset)
    parts = []
    for name, rows in tables.items():
        spec, stored = specs[name], spark.table(targets[name])
        reported = {f.name: reconcile.warehouse_type(f.dataType) for f in stored.schema.fields}
        parts.append(reconcile.warehouse_schema_problems(spark, reported, spec))
        if all(c in stored.columns for c in spec.columns):
            diff = reconcile.multiset_diff(rows, stored, spec.columns)
            side = F.when(F.col("side") == "left", F.lit("only published x")).otherwise(F.lit("only in the warehouse x"))
            detail = F.concat(side, F.col("n_extra").cast("string"))
            parts.append(quality.problems(diff, "warehouse rows", name, quality.key_text(spec.keys), detail))
    return quality.all_problems(parts)
