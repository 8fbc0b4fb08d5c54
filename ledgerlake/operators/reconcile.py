"""Reconciliation between two copies of the same data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import quality
from ledgerlake.spec import TableSpec

# Type names of a warehouse for the types of the curated contracts, and the
# aliases under which it may report them.
WAREHOUSE_TYPES = {
    "int": "INTEGER",
    "bigint": "INTEGER",
    "string": "STRING",
    "date": "DATE",
    "decimal": "NUMERIC",
    "double": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}
WAREHOUSE_ALIASES = {"INT64": "INTEGER", "FLOAT64": "FLOAT", "BOOL": "BOOLEAN"}


def multiset_diff(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that one side has more often, with ``side`` (``left`` or ``right``) and ``n_extra``.

    Equal rows cancel out in one aggregation that combines map-side, for both directions.
    """
    tagged = lambda rows, sign: rows.select(*columns, F.lit(sign).cast("bigint").alias("_sign"))
    net = (
        tagged(left, 1)
        .unionByName(tagged(right, -1))
        .groupBy(*columns)
        .agg(F.sum("_sign").alias("_net"))
        .filter(F.col("_net") != 0)
    )
    side = F.when(F.col("_net") > 0, F.lit("left")).otherwise(F.lit("right"))
    return net.select(*columns, side.alias("side"), F.abs("_net").alias("n_extra"))


def recompute_problems(
    table: DataFrame, expected: DataFrame, name: str, spec: TableSpec
) -> DataFrame:
    """Whole rows that differ from an independent recomputation."""
    diff = multiset_diff(table, expected, spec.columns)
    detail = F.concat(
        F.when(F.col("side") == "left", F.lit("unexpected row")).otherwise(F.lit("missing row")),
        F.lit(" x"),
        F.col("n_extra").cast("string"),
    )
    return quality.problems(diff, "recomputation", name, quality.key_text(spec.keys), detail)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, n`` of several tables."""
    return quality.all_problems(
        [rows.agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n") for t, rows in tables.items()]
    )


def count_problems(lake: DataFrame, source: DataFrame) -> DataFrame:
    """Tables whose row count differs; only tables both sides have are compared."""
    joined = lake.select("table", F.col("n").alias("_lake")).join(
        source.select("table", F.col("n").alias("_source")), "table"
    )
    bad = joined.filter(F.col("_lake") != F.col("_source"))
    detail = F.concat(
        F.lit("lake "), F.col("_lake").cast("string"), F.lit(", source "), F.col("_source").cast("string")
    )
    return bad.select(
        F.lit("row count").alias("check"), "table", F.lit("rows").alias("key"), detail.alias("detail")
    )


def source_totals(
    rows: DataFrame, entity: str, started: str, amount: str, deleted_at: str
) -> DataFrame:
    """Totals and counts per entity and month of the active rows of a source table."""
    month = F.trunc(F.col(started).cast("date"), "month").alias("period")
    return (
        rows.filter(F.col(deleted_at).isNull())
        .groupBy(F.col(entity).alias("entity"), month)
        .agg(F.sum(amount).alias("total"), F.count("*").alias("n"))
    )


def total_problems(
    balance: DataFrame,
    entity: str,
    period: str,
    total: str,
    n: str,
    source: DataFrame,
    table: str,
) -> DataFrame:
    """Entity-months whose total or count differs between the lake and its source."""
    lake = balance.filter((F.col(n) != 0) | (F.col(total) != 0)).select(
        F.col(entity).alias("entity"), F.col(period).alias("period"), F.col(total).alias("total"), F.col(n).alias("n")
    )
    return quality.compare_totals(
        lake, source, ["entity", "period"], ["total", "n"], "source totals", table, ("lake", "source")
    )


def warehouse_schema_problems(
    spark: SparkSession, reported: Mapping[str, str], spec: TableSpec
) -> DataFrame:
    """Column names and types that a warehouse reports, against the contract."""
    expected = {f.name: warehouse_type(f.dataType) for f in spec.schema.fields}
    found = {c: WAREHOUSE_ALIASES.get(t, t) for c, t in reported.items()}
    lines = [(c, "column is missing") for c in expected if c not in found]
    lines += [(c, "column is not in the contract") for c in found if c not in expected]
    lines += [
        (c, f"type is {found[c]}, the contract says {expected[c]}")
        for c in expected
        if c in found and found[c] != expected[c]
    ]
    rows = [("warehouse schema", spec.name, column, detail) for column, detail in lines]
    return spark.createDataFrame(rows, quality.PROBLEM)


def warehouse_type(data_type: T.DataType) -> str:
    """The name that a warehouse has for a type of the contract."""
    name = "decimal" if isinstance(data_type, T.DecimalType) else data_type.simpleString()
    return WAREHOUSE_TYPES.get(name, name.upper())


def volume_problems(
    curated: DataFrame, expected: DataFrame, keys: Sequence[str], measures: Sequence[str], table: str
) -> DataFrame:
    """Totals and counts of generated data against the same figures by formula."""
    return quality.compare_totals(
        curated, expected, keys, measures, "volume", table, ("curated", "expected")
    )


def nonzero(total: Column, n: Column) -> Column:
    return (n != 0) | (total != 0)
