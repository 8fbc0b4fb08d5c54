"""Calendar periods as dates (the first day of the period)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months that one step of each unit spans.
MONTHS_PER_STEP = {"month": 1, "quarter": 3, "year": 12}
# Days that one step of each unit spans.
DAYS_PER_STEP = {"day": 1, "week": 7}


def bucket(instant: Column, unit: str = "month") -> Column:
    """First day of the period that contains ``instant``."""
    day = instant.cast("date")
    return day if unit == "day" else F.trunc(day, unit)


def index(period: Column, unit: str = "month") -> Column:
    """Consecutive integer of a period, so that the previous period is ``index - 1``."""
    if unit in MONTHS_PER_STEP:
        months = F.year(period) * 12 + F.month(period) - 1
        return F.floor(months / MONTHS_PER_STEP[unit]).cast("int")
    return F.floor(F.unix_date(period) / DAYS_PER_STEP[unit]).cast("int")


def shift(period: Column, steps: int, unit: str = "month") -> Column:
    """The period ``steps`` later."""
    if unit in MONTHS_PER_STEP:
        return F.add_months(period, steps * MONTHS_PER_STEP[unit])
    return F.date_add(period, steps * DAYS_PER_STEP[unit])


def label(period: Column) -> Column:
    """Axis label ``yyyy-MM``; sorts like the period itself."""
    return F.date_format(period, "yyyy-MM")
