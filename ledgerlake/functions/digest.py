"""Order-independent content digests, computable with map-side aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sign of a NULL, what follows a value's length and its text, and hex digits kept of each row's MD5.
NULL_SIGN = "-"
AFTER_LENGTH, AFTER_TEXT = ":", ","
HEX_DIGITS = 15


def row_text(columns: Sequence[str]) -> Column:
    """A row as text that no other row has: every value behind its length, NULL as a sign of its own."""
    def field(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        known = F.concat(F.length(text).cast("string"), F.lit(AFTER_LENGTH), text)
        return F.concat(F.coalesce(known, F.lit(NULL_SIGN)), F.lit(AFTER_TEXT))

    return F.concat(*[field(c) for c in columns])


def row_digest(columns: Sequence[str]) -> Column:
    """60-bit integer of a row."""
    md5 = F.md5(row_text(columns))
    return F.conv(F.substring(md5, 1, HEX_DIGITS), 16, 10).cast("decimal(20,0)")


def content_digest(columns: Sequence[str]) -> Column:
    """Aggregate digest of a table: equal multisets of rows have equal digests."""
    total = F.sum(row_digest(columns).cast("decimal(28,0)"))
    return F.coalesce(total, F.lit(0)).cast("decimal(38,0)")
