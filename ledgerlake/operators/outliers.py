"""Unusually high amounts per group, by interquartile range.

Amounts are compared in whole cents, so quartiles are exact multiples of a quarter cent and
a value that lies on a fence is never pushed over it by binary rounding.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import money
from ledgerlake.operators.ranking import order_statistics

# Fence factors, smallest group that is judged, severity names.
MILD_FACTOR = "1.5"
EXTREME_FACTOR = "3.0"
MIN_GROUP = 8
MILD, EXTREME = "mild", "extreme"

# Size of a quantile sketch, and the share of a group by which a rank may then be off (with 99 %).
SKETCH_SIZE = 400
RANK_ERROR = 0.01

# Wide enough for quartiles and fences of any decimal(18,2) amount.
QUARTILE = "decimal(20,4)"
FENCE = "decimal(24,6)"


@dataclass(frozen=True)
class Fences:
    """Parameters of the test."""

    mild: str = MILD_FACTOR
    extreme: str = EXTREME_FACTOR
    min_rows: int = MIN_GROUP
    mild_name: str = MILD
    extreme_name: str = EXTREME


def _cents(amount: str) -> Column:
    return (F.col(amount) * money.CENTS_PER_UNIT).cast("bigint")


def _from_quarter_cents(quarters: Column) -> Column:
    return (quarters.cast("decimal(19,0)") * F.lit("0.0025").cast("decimal(4,4)")).cast(QUARTILE)


# The quartiles as shares of the last rank, in quarters.
QUARTERS = {"q1": 1, "q3": 3}


def _quartiles(rows: DataFrame, group: Sequence[str], amount: str) -> DataFrame:
    """``group…, n_group, _q1, _q3`` with both quartiles in quarter cents, in whole numbers.

    Equal amounts are counted first, on the map side as well; then amounts are ranked only within the value buckets
    that hold a wanted rank, so no task sees all amounts of a large group.
    """
    last = F.col("_n") - 1
    ends = {f"_{q}_{f.__name__}": f(last * part / 4) for q, part in QUARTERS.items() for f in (F.floor, F.ceil)}
    cents = rows.select(*group, _cents(amount).alias("_cents"))
    found = order_statistics(cents, group, "_cents", ends, all_rows="n_group")

    def between(q: str, part: int) -> Column:
        low, high = F.col(f"_{q}_floor"), F.col(f"_{q}_ceil")
        return (low * 4 + (high - low) * (last * part % 4)).alias(f"_{q}")

    return found.select(*group, "n_group", *[between(q, part) for q, part in QUARTERS.items()])


def quartile_sketches(rows: DataFrame, group: Sequence[str], amount: str, k: int = SKETCH_SIZE) -> DataFrame:
    """``group…, n_group, sketch``: a quantile sketch of the amounts of every group, of a size that ``k`` bounds.

    Sketches of finer groups, such as those of each month, can be kept and merged: :func:`merged_sketches`.
    """
    cents = rows.select(*group, _cents(amount).alias("_cents"))
    return cents.groupBy(*group).agg(F.count("*").alias("n_group"), F.kll_sketch_agg_bigint("_cents", k).alias("sketch"))


def merged_sketches(sketches: DataFrame, group: Sequence[str], k: int = SKETCH_SIZE) -> DataFrame:
    """``group…, n_group, sketch`` of coarser groups."""
    return sketches.groupBy(*group).agg(F.sum("n_group").alias("n_group"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def sketched_fences(sketches: DataFrame, group: Sequence[str], fences: Fences = Fences()) -> DataFrame:
    """As :func:`group_fences`, from sketches: each quartile is an amount of the group whose rank is off by little.

    With ``k`` of :data:`SKETCH_SIZE` the rank is off by at most :data:`RANK_ERROR` of the group with a probability of 99 %;
    groups of fewer than ``k`` amounts are exact up to interpolation: the amount at the rank is taken.
    """
    known = F.kll_sketch_get_n_bigint("sketch") > 0
    quartile = lambda share: F.when(known, F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)) * 4)
    quartiles = [quartile(part / 4).alias(f"_{q}") for q, part in QUARTERS.items()]
    return _with_fences(sketches.select(*group, "n_group", *quartiles), fences)


def _with_fences(quartiles: DataFrame, fences: Fences) -> DataFrame:
    fence = lambda factor: (
        F.col("q3") + F.lit(factor).cast("decimal(6,2)") * F.col("iqr")
    ).cast(FENCE)
    return (
        quartiles.withColumn("q1", _from_quarter_cents(F.col("_q1")))
        .withColumn("q3", _from_quarter_cents(F.col("_q3")))
        .withColumn("iqr", (F.col("q3") - F.col("q1")).cast(QUARTILE))
        .withColumn("mild_fence", fence(fences.mild))
        .withColumn("extreme_fence", fence(fences.extreme))
        .drop("_q1", "_q3")
    )


def group_fences(
    rows: DataFrame, group: Sequence[str], amount: str, fences: Fences = Fences()
) -> DataFrame:
    """``group…, n_group, q1, q3, iqr, mild_fence, extreme_fence`` of every group.

    ``n_group`` counts all rows; quartiles interpolate linearly over non-null amounts.
    """
    return _with_fences(_quartiles(rows.select(*group, amount), group, amount), fences)


def judged(stats: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """Groups with enough rows and a spread; the others are not judged."""
    return stats.filter((F.col("n_group") >= fences.min_rows) & (F.col("iqr") > 0))


def _severity(amount: str, fences: Fences) -> Column:
    extreme = F.col(amount) > F.col("extreme_fence")
    return F.when(extreme, F.lit(fences.extreme_name)).otherwise(F.lit(fences.mild_name))


def iqr_outliers(
    rows: DataFrame,
    group: Sequence[str],
    amount: str,
    keep: Sequence[str],
    fences: Fences = Fences(),
) -> DataFrame:
    """Rows strictly above the mild fence of their group, with severity and excess.

    Fences are joined without a hint: Spark broadcasts few groups and splits a group that is
    skewed. A row without a group key is not judged. The output has only the listed columns:
    free text stays behind.
    """
    needed = rows.select(*dict.fromkeys([*group, amount, *keep]))
    # Said as the join below implies it, so that both uses of the amounts in the fences have one plan and one shuffle.
    needed = needed.filter(reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in group]))
    stats = judged(group_fences(needed, group, amount, fences), fences)
    found = needed.join(stats, list(group)).filter(F.col(amount) > F.col("mild_fence"))
    cents = lambda name: F.round(F.col(name), 2).cast(money.MONEY).alias(name)
    excess = F.round(F.col(amount) - F.col("mild_fence"), 2).cast(money.MONEY)
    return found.select(
        *needed.columns,
        "n_group",
        cents("q1"),
        cents("q3"),
        cents("iqr"),
        cents("mild_fence"),
        cents("extreme_fence"),
        excess.alias("excess"),
        _severity(amount, fences).alias("severity"),
    )


def run_summary(
    stats: DataFrame, found: DataFrame, fences: Fences = Fences()
) -> DataFrame:
    """``measure, n``: rows and groups seen, groups judged or skipped and why, outliers found.

    One pass over the group statistics and one over the outliers.
    """
    enough = F.col("n_group") >= fences.min_rows
    spread = F.coalesce(F.col("iqr") > 0, F.lit(False))
    seen = stats.agg(
        F.coalesce(F.sum("n_group"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_groups"),
        F.count_if(enough & spread).alias("n_judged"),
        F.count_if(~enough).alias("n_too_small"),
        F.count_if(enough & ~spread).alias("n_flat"),
    )
    reported = found.agg(
        F.count_if(F.col("severity") == fences.mild_name).alias("n_mild"),
        F.count_if(F.col("severity") == fences.extreme_name).alias("n_extreme"),
        F.count("*").alias("n_outliers"),
    )
    long = lambda row: row.unpivot([], row.columns, "measure", "n")
    return long(seen).unionByName(long(reported))


def summarise_run(rows: DataFrame, group: Sequence[str], amount: str, fences: Fences = Fences()) -> DataFrame:
    """:func:`run_summary` of the rows; the fences are computed once and serve both of its passes."""
    stats = group_fences(rows, group, amount, fences)
    chosen = rows.select(*group, amount).join(judged(stats, fences), list(group)).filter(F.col(amount) > F.col("mild_fence"))
    return run_summary(stats, chosen.select(_severity(amount, fences).alias("severity")), fences)


def hotspots(found: DataFrame, group: Sequence[str], limit: int | None = None) -> DataFrame:
    """Where outliers concentrate, most first."""
    ranked = (
        found.groupBy(*group)
        .agg(F.count("*").alias("n_outliers"))
        .orderBy(F.desc("n_outliers"), *group)
    )
    return ranked if limit is None else ranked.limit(limit)
