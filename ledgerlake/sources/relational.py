"""Read-only access to the source database, for reconciliation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import reconcile


# What a connection to the source is told first.
READ_ONLY_UTC = "SET SESSION transaction_read_only = 1, SESSION time_zone = '+00:00'"


class UnknownTable(ValueError):
    """The table is not on the allow list."""


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database over JDBC.

    ``partitioning`` gives, per table, the numeric column, bounds and number of partitions
    of a parallel read; the driver jar has to be on the classpath. Every connection starts with ``session``: it may only
    read, and its clock is UTC, so that months are cut as in the lake. ``fetch_rows`` come per round trip, or a driver may
    gather a whole table in memory.
    """

    spark: SparkSession
    url: str
    tables: Iterable[str]
    properties: Mapping[str, str] = field(default_factory=dict)
    partitioning: Mapping[str, tuple[str, int, int, int]] = field(default_factory=dict)
    session: str = READ_ONLY_UTC
    fetch_rows: int = 10_000

    def _reader(self, **options: object):
        return self.spark.read.format("jdbc").options(
            url=self.url, sessionInitStatement=self.session, fetchsize=self.fetch_rows, **options, **self.properties
        )

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise UnknownTable(name)
        reader = self._reader(dbtable=name)
        if name in self.partitioning:
            column, lower, upper, parts = self.partitioning[name]
            reader = reader.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
            )
        return reader.load()

    def monthly_totals(self, name: str, entity: str, started: str, amount: str, deleted_at: str) -> DataFrame:
        """``entity, period, total, n`` of the active rows, added up by the database: a row per entity and month travels.

        As :func:`ledgerlake.operators.reconcile.source_totals` of the whole table.
        """
        if name not in self.tables:
            raise UnknownTable(name)
        month = f"CAST({started} AS DATE)"
        first = f"DATE_ADD({month}, INTERVAL 1 - DAYOFMONTH({month}) DAY)"
        statement = (
            f"SELECT {entity} AS entity, {first} AS period, SUM({amount}) AS total, COUNT(*) AS n FROM {name} "
            f"WHERE {deleted_at} IS NULL GROUP BY {entity}, {first}"
        )
        return self._reader(query=statement).load()

    def row_count(self, name: str) -> DataFrame:
        """``table, n``, counted by the database."""
        if name not in self.tables:
            raise UnknownTable(name)
        return self._reader(query=f"SELECT '{name}' AS `table`, COUNT(*) AS n FROM {name}").load()


@dataclass(frozen=True)
class ParquetSource:
    """The same interface over a Parquet export."""

    spark: SparkSession
    folder: str
    tables: Iterable[str]

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise UnknownTable(name)
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def monthly_totals(self, name: str, entity: str, started: str, amount: str, deleted_at: str) -> DataFrame:
        """``entity, period, total, n`` of the active rows."""
        return reconcile.source_totals(self.table(name), entity, started, amount, deleted_at)

    def row_count(self, name: str) -> DataFrame:
        """``table, n``."""
        return reconcile.row_counts({name: self.table(name)})


@dataclass(frozen=True)
class FrameSource:
    """The same interface over DataFrames."""

    tables: Mapping[str, DataFrame]

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise UnknownTable(name)
        return self.tables[name]

    def monthly_totals(self, name: str, entity: str, started: str, amount: str, deleted_at: str) -> DataFrame:
        """``entity, period, total, n`` of the active rows."""
        return reconcile.source_totals(self.table(name), entity, started, amount, deleted_at)

    def row_count(self, name: str) -> DataFrame:
        """``table, n``."""
        return reconcile.row_counts({name: self.table(name)})
