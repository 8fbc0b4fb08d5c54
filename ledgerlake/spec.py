"""Table specifications: one declaration drives envelopes, conversions and contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T


def _as_text(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


@dataclass(frozen=True)
class TableSpec:
    """Columns (as DDL text, parsed on first use), key and rules of one table.

    ``nullable`` lists the only columns a contract lets be NULL; ``None`` means that
    nothing is said about nulls.
    """

    name: str
    ddl: str
    keys: tuple[str, ...] = ("id",)
    nullable: tuple[str, ...] | None = None
    soft_delete: str | None = None

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [] if self.nullable is None else [c for c in self.columns if c not in self.nullable]

    def envelope(self, before: str = "keys") -> T.StructType:
        """Schema of a change event, every leaf as text.

        Spark does not prune the schema of ``from_json`` through the nested envelope, so
        ``before`` is narrowed to the key columns unless the caller needs ``"all"``.
        """
        old = self.keys if before == "keys" else self.columns
        payload = T.StructType(
            [
                T.StructField("op", T.StringType()),
                T.StructField("before", _as_text(old)),
                T.StructField("after", _as_text(self.columns)),
            ]
        )
        return T.StructType([T.StructField("payload", payload)])
