"""Money columns: fixed-scale decimals, percentages and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public types of money and change columns, and the display pattern.
MONEY = "decimal(18,2)"
CHANGE = "decimal(26,2)"
CENTS_PER_UNIT = 100


def total(amount: Column) -> Column:
    """Sum as money; a group without amounts totals zero."""
    return F.coalesce(F.sum(amount), F.lit(0)).cast(MONEY)


def percent_change(current: Column, prior: Column) -> Column:
    """Change against ``prior`` in percent, two decimals; NULL when there is nothing to divide by."""
    ratio = F.try_divide((current - prior) * 100, prior)
    return F.round(ratio, 2).cast(CHANGE)


def display(amount: Column) -> Column:
    """Text such as ``$1,179,009.35``, with the minus sign before the currency sign."""
    sign = F.when(amount < 0, F.lit("-$")).otherwise(F.lit("$"))
    return F.concat(sign, F.format_number(F.abs(amount), 2))
