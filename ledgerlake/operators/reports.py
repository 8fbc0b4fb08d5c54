"""Report operators over curated tables. Only reports are sorted; a table has no order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import money, periods

# Colours of severities and of the direction of a change.
SEVERITY_COLOURS = {"extreme": "#C62828", "mild": "#F9A825"}
DEFAULT_COLOUR = "#000000"
UP_COLOUR, DOWN_COLOUR = "red", "green"


def dimension(rows: DataFrame, column: str) -> DataFrame:
    """One row per value of a fact column."""
    return rows.select(column).distinct()


def period_dimension(rows: DataFrame, period: str) -> DataFrame:
    """One row per period with its axis label."""
    return dimension(rows, period).withColumn("label", periods.label(F.col(period)))


def filter_by_dimensions(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows that the filtered dimensions select; a dimension the fact lacks is ignored.

    Filters flow from dimensions to facts only. Spark broadcasts the small dimensions.
    """
    for column, dim in dimensions.items():
        if column in fact.columns:
            fact = fact.join(dim.select(column), column, "left_semi")
    return fact


def kpi_totals(balance: DataFrame, total_in: str, total_out: str, by: Sequence[str] = ()) -> DataFrame:
    """Inflows, outflows and net of whatever rows are selected."""
    return (
        balance.groupBy(*by)
        .agg(money.total(F.col(total_in)).alias("inflows"), money.total(F.col(total_out)).alias("outflows"))
        .withColumn("net", (F.col("inflows") - F.col("outflows")).cast(money.MONEY))
    )


def kpi_cards(totals: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact amounts as text, for cards."""
    return totals.select(*by, *[money.display(F.col(m)).alias(m) for m in measures])


def portfolio_running(balance: DataFrame, period: str, net: str) -> DataFrame:
    """Net of all selected entities together and its running total over the periods.

    The window runs over one row per calendar period, whatever the number of facts.
    """
    per_period = balance.groupBy(period).agg(money.total(F.col(net)).alias("net"))
    upto = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_period.withColumn("running_net", F.sum("net").over(upto).cast(money.MONEY))


def spend_by_period(spend: DataFrame, period: str, name: str, total: str) -> DataFrame:
    """Spend per period and name over all selected entities, as one row each."""
    return spend.groupBy(period, name).agg(money.total(F.col(total)).alias("total"))


def spend_columns(
    spend: DataFrame, period: str, name: str, total: str, names: Mapping[str, str], other: str = "other"
) -> DataFrame:
    """The same with one column per name; ``names`` maps a value to its column name, so no
    job has to look for the values first. All other names share the column ``other``, so a
    row sums up to the spend of its period."""
    amount = F.coalesce(F.col(total), F.lit(0)).cast(money.MONEY)
    rest = F.col(name).isNull() | ~F.col(name).isin(list(names))
    return spend.groupBy(period).agg(
        *[money.total(F.when(F.col(name) == v, amount)).alias(c) for v, c in names.items()],
        money.total(F.when(rest, amount)).alias(other),
    )


def change_with_total(
    spend: DataFrame,
    name: str,
    total: str,
    prior: str,
    by: Sequence[str] = (),
    label: str = "TOTAL",
) -> DataFrame:
    """Current and prior spend per name and overall, with the change recomputed on the sums.

    ``prior`` is summed over the current rows: a name without spend this period does not
    add its prior total. Percentages are never added up. A zero or missing prior is blank.
    """
    return (
        spend.groupBy(*by, name)
        .agg(F.sum(total).alias("_current"), F.sum(prior).alias("_prior"))
        .groupingSets([[*by, name], list(by)], *by, name)
        .agg(
            F.sum("_current").cast(money.MONEY).alias("current_total"),
            F.sum("_prior").cast(money.MONEY).alias("prior_total"),
            F.grouping(name).alias("_is_total"),
        )
        .select(
            *by,
            F.when(F.col("_is_total") > 0, F.lit(label)).otherwise(F.col(name)).alias(name),
            "current_total",
            "prior_total",
            money.percent_change(F.col("current_total"), F.col("prior_total")).alias("change_pct"),
        )
    )


def change_colour(change: Column) -> Column:
    """Spending more is red, less is green."""
    return F.when(change > 0, F.lit(UP_COLOUR)).when(change < 0, F.lit(DOWN_COLOUR))


def change_ranked(rows: DataFrame, change: str, tie_break: Sequence[str]) -> DataFrame:
    """Rows by change, largest first, blanks last, with the direction colour."""
    return rows.withColumn("colour", change_colour(F.col(change))).orderBy(
        F.col(change).desc_nulls_last(), *tie_break
    )


def severity_colour(severity: Column, colours: Mapping[str, str] = SEVERITY_COLOURS) -> Column:
    column = F.lit(DEFAULT_COLOUR)
    for name, colour in colours.items():
        column = F.when(severity == name, F.lit(colour)).otherwise(column)
    return column


def outlier_report(found: DataFrame, key: str, colours: Mapping[str, str] = SEVERITY_COLOURS) -> DataFrame:
    """Outliers with their colour, largest excess first."""
    return found.withColumn("colour", severity_colour(F.col("severity"), colours)).orderBy(
        F.desc("excess"), key
    )


def top_outliers(found: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` largest excesses."""
    return found.orderBy(F.desc("excess"), key).limit(n)


def latest_periods(rows: DataFrame, entity: str, period: str, n: int, *tie_break: str) -> DataFrame:
    """The last ``n`` rows of each entity; pruned per task before the shuffle."""
    order = Window.partitionBy(entity).orderBy(F.desc(period), *tie_break)
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n).drop("_rank")


def entity_period_report(
    spend: DataFrame, entity: str, entity_value, period: str, period_value, name: str, total: str
) -> DataFrame:
    """Spend of one entity in one period, largest first."""
    chosen = (F.col(entity) == F.lit(entity_value)) & (F.col(period) == F.lit(period_value).cast("date"))
    return spend.filter(chosen).select(name, total).orderBy(F.desc(total), name)
