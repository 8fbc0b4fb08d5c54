"""Ranks and order statistics that stay exact when one group holds most of the rows.

Each operator first counts rows per (group, coarse bucket of the ordering value), which
combines map-side, and only then sorts inside one bucket. No task sees a whole group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A coarse bucket drops this many low bits. With values below 2**40 (a decimal(12,2) in
# cents) a group has at most 2**20 buckets of at most 2**20 distinct values, which bounds
# every window.
BUCKET_BITS = 20


def _bucket(value: Column, bits: int) -> Column:
    return F.shiftright(value.cast("bigint"), bits)


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of key columns of two aliased DataFrames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys],
    )


def ordinals(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    tie_break: Sequence[str] = (),
    alias: str = "ordinal",
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Position of each row within its key, from 1, by an integer ``order`` column.

    Equals ``row_number() over (partition by keys order by order, tie_break)``; the key
    columns must not be NULL. The final window reuses the partitioning of the join.
    """
    bucketed = rows.withColumn("_bucket", _bucket(F.col(order), bits))
    sizes = bucketed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order, *tie_break)
    joined = bucketed.join(before, [*keys, "_bucket"])
    position = (F.row_number().over(inside) + F.col("_before")).cast("bigint")
    return joined.select(*rows.columns, position.alias(alias))


def order_statistics(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, Column],
    bits: int = BUCKET_BITS,
    all_rows: str | None = None,
) -> DataFrame:
    """Exact order statistics of an integer ``value`` per key.

    ``ranks`` maps an output name to a 0-based rank, given as an expression of ``_n``, the
    number of non-null values of the key. Returns ``keys…, _n`` and one column per name. With ``all_rows``, a column
    of that name counts all rows of the key, and keys that have no value stay, without statistics.
    """
    chosen = rows if all_rows else rows.filter(F.col(value).isNotNull())
    counts = (
        chosen.groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_c"))
        .withColumn("_bucket", _bucket(F.col("_v"), bits))
    )
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    present = F.when(F.col("_bucket").isNotNull(), F.col("_c")).otherwise(0)
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), r.cast("bigint").alias("rank")) for n, r in ranks.items()]
    )
    totals = [all_rows] if all_rows else []
    coarse = (
        counts.groupBy(*keys, "_bucket")
        .agg(F.sum("_c").alias("_c"))
        .withColumn("_before", F.coalesce(F.sum(present).over(earlier), F.lit(0)))
        .withColumn("_n", F.sum(present).over(per_key))
        .withColumns({name: F.sum("_c").over(per_key) for name in totals})
        .withColumn("_wanted", _ranks_in(wanted, F.col("_before"), present))
        .filter((F.size("_wanted") > 0) | (F.col("_bucket").isNull() & (F.col("_n") == 0)))
    )
    on = same_keys("c", "s", [*keys, "_bucket"])
    columns = [F.col(f"c.`{k}`") for k in keys]
    within = Window.partitionBy(*keys, "_bucket").orderBy("_v")
    before = F.sum("_c").over(within.rowsBetween(Window.unboundedPreceding, -1))
    hits = (
        counts.alias("c")
        .join(coarse.alias("s"), on)
        .select(*columns, "c._bucket", "c._v", "c._c", "s._before", "s._n", "s._wanted", *[f"s.`{name}`" for name in totals])
        .withColumn("_before", F.col("_before") + F.coalesce(before, F.lit(0)))
        .withColumn("_hit", F.explode_outer(_ranks_in(F.col("_wanted"), F.col("_before"), F.col("_c"))))
    )
    return hits.groupBy(*keys, "_n", *totals).agg(
        *[F.max(F.when(F.col("_hit.name") == n, F.col("_v"))).alias(n) for n in ranks]
    )


def _ranks_in(wanted: Column, before: Column, count: Column) -> Column:
    return F.filter(wanted, lambda w: (w["rank"] >= before) & (w["rank"] < before + count))
