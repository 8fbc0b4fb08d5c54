"""Period rollups: totals, balances, running balances, spend by dimension, period change."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import money, periods


def active_rows(rows: DataFrame, deleted_at: str) -> DataFrame:
    """Rows without a soft-delete stamp."""
    return rows.filter(F.col(deleted_at).isNull())


def with_period(rows: DataFrame, instant: str, unit: str = "month", alias: str = "period") -> DataFrame:
    """Each row counts once, in the period of its start."""
    return rows.withColumn(alias, periods.bucket(F.col(instant), unit))


def period_totals(
    rows: DataFrame, entity: str, period: str, amount: str, total: str = "total", n: str = "n"
) -> DataFrame:
    """Sum and count per entity and period."""
    return rows.groupBy(entity, period).agg(
        money.total(F.col(amount)).alias(total), F.count("*").alias(n)
    )


def period_balance(
    entries: DataFrame,
    entity: str,
    period: str,
    amount: str,
    is_inflow: Column,
    names: Sequence[str] = ("total_in", "total_out", "balance", "n_in", "n_out"),
) -> DataFrame:
    """Inflow and outflow totals, their difference and counts per entity and period.

    Both directions are folded in one conditional aggregation: one shuffle and no outer
    join, and an entity without a period gets one row rather than two.
    """
    total_in, total_out, balance, n_in, n_out = names
    inflow = F.when(is_inflow, F.col(amount))
    outflow = F.when(~is_inflow, F.col(amount))
    return (
        entries.groupBy(entity, period)
        .agg(
            money.total(inflow).alias(total_in),
            money.total(outflow).alias(total_out),
            F.count_if(is_inflow).alias(n_in),
            F.count_if(~is_inflow).alias(n_out),
        )
        .select(
            entity,
            period,
            total_in,
            total_out,
            (F.col(total_in) - F.col(total_out)).cast(money.MONEY).alias(balance),
            n_in,
            n_out,
        )
    )


def both_directions(inflows: DataFrame, outflows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inflows and outflows as one set of entries with an ``is_inflow`` flag."""
    return inflows.select(*columns, F.lit(True).alias("is_inflow")).unionByName(
        outflows.select(*columns, F.lit(False).alias("is_inflow"))
    )


def running_total(
    rows: DataFrame, keys: Sequence[str], period: str, value: str, alias: str
) -> DataFrame:
    """Running sum over the periods that exist; ``rows`` holds one row per key and period,
    so a window never exceeds the number of calendar periods."""
    upto = Window.partitionBy(*keys).orderBy(period).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return rows.withColumn(alias, F.sum(value).over(upto).cast(money.MONEY))


def closing_value(rows: DataFrame, entity: str, period: str, value: str, alias: str) -> DataFrame:
    """Value at the last period of each entity."""
    return rows.groupBy(entity).agg(
        F.max(period).alias(period), F.max_by(value, period).alias(alias)
    )


def label_from(
    rows: DataFrame,
    dim_id: str,
    catalogue: DataFrame,
    catalogue_id: str,
    catalogue_name: str,
    alias: str,
    missing: str,
) -> DataFrame:
    """Name of ``dim_id``, or ``missing`` when the catalogue does not have it.

    No broadcast hint: Spark broadcasts a catalogue below its size threshold and otherwise
    runs a sort-merge join whose skewed partitions AQE splits.
    """
    names = catalogue.select(
        F.col(catalogue_id).alias(dim_id), F.col(catalogue_name).alias("_name")
    )
    return (
        rows.join(names, dim_id, "left")
        .withColumn(alias, F.coalesce(F.col("_name"), F.lit(missing)))
        .drop("_name")
    )


def dimension_spend(
    entries: DataFrame,
    entity: str,
    period: str,
    dim_id: str,
    amount: str,
    sentinel,
    total: str = "total",
    n: str = "n",
) -> DataFrame:
    """Total and count per entity, period and dimension id; no id becomes ``sentinel``.

    Names are attached afterwards (:func:`label_from`): the join then runs on the
    aggregate, not on every entry, and a hot id is combined before any shuffle.
    """
    filled = F.coalesce(F.col(dim_id), F.lit(sentinel)).alias(dim_id)
    return (
        entries.select(entity, period, filled, amount)
        .groupBy(entity, period, dim_id)
        .agg(money.total(F.col(amount)).alias(total), F.count("*").alias(n))
    )


def period_change(
    rows: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str,
    unit: str = "month",
    prior: str = "prior_total",
    change: str = "change_pct",
) -> DataFrame:
    """Value of the previous calendar period and the change in percent.

    ``rows`` has one row per key and period. The previous period is looked up in a range
    frame over the period index: a gap gives NULL, unlike ``lag``, and there is no self-join.
    A NULL key or period never has a previous period.
    """
    index = periods.index(F.col(period), unit)
    frame = Window.partitionBy(*keys).orderBy("_index").rangeBetween(-1, -1)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, period)])
    return (
        rows.withColumn("_index", index)
        .withColumn(prior, F.when(known, F.max(value).over(frame)))
        .drop("_index")
        .withColumn(change, money.percent_change(F.col(value), F.col(prior)))
    )


def period_change_by_join(
    rows: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str,
    unit: str = "month",
    prior: str = "prior_total",
    change: str = "change_pct",
) -> DataFrame:
    """The same result by joining each row to the row one period earlier.

    A second formulation for the recomputation checks.
    """
    earlier = rows.select(
        *keys, periods.shift(F.col(period), 1, unit).alias(period), F.col(value).alias(prior)
    )
    return rows.join(earlier, [*keys, period], "left").withColumn(
        change, money.percent_change(F.col(value), F.col(prior))
    )


def span_profile(
    entries: DataFrame,
    group: str,
    started: str,
    ended: str,
    recurrence: str,
    dim_id: str,
) -> DataFrame:
    """How many entries end, recur, span several months or have no dimension, per group."""
    spans = F.trunc(F.col(ended).cast("date"), "month") != F.trunc(F.col(started).cast("date"), "month")
    return entries.groupBy(group).agg(
        F.count("*").alias("n_active"),
        F.count(ended).alias("n_with_end"),
        F.count(recurrence).alias("n_recurring"),
        F.count_if(spans).alias("n_multi_month"),
        F.count_if(F.col(dim_id).isNull()).alias("n_without_dimension"),
    )
