"""Data contracts and coherence checks.

Every check returns problems as ``check, table, key, detail`` (all text), empty when the
data is sound; :func:`gate` stops a run that has any.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import money
from ledgerlake.operators import rollup
from ledgerlake.operators.changes import DELETE, LAST_OP
from ledgerlake.operators.outliers import Fences
from ledgerlake.spec import TableSpec

PROBLEM = "check STRING, table STRING, key STRING, detail STRING"
# Examples a report shows, and how far a derived cent may be off.
MAX_EXAMPLES = 5
TOLERANCE = "0.01"


class QualityError(RuntimeError):
    """A gate found problems."""


def _text(*parts) -> Column:
    """Concatenation in which a NULL shows as ``NULL``; plain strings are literals."""
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("NULL")) for c in columns])


def key_text(keys: Sequence[str]) -> Column:
    """Key columns joined by ``|``."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("NULL")) for k in keys])


def problems(rows: DataFrame, check: str, table: str, key: Column, detail: Column) -> DataFrame:
    """Each input row as one problem."""
    return rows.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), key.alias("key"), detail.alias("detail")
    )


def all_problems(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ contract, keys, values
def contract_problems(spark: SparkSession, schema: T.StructType, spec: TableSpec) -> DataFrame:
    """Missing and extra columns and columns of another type; reads the schema only."""
    found = {f.name: f.dataType.simpleString() for f in schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    lines = [(c, "column is missing") for c in expected if c not in found]
    lines += [(c, "column is not in the contract") for c in found if c not in expected]
    lines += [
        (c, f"type is {found[c]}, the contract says {expected[c]}")
        for c in expected
        if c in found and found[c] != expected[c]
    ]
    rows = [("contract", spec.name, column, detail) for column, detail in lines]
    return spark.createDataFrame(rows, PROBLEM)


def forbidden_columns(
    spark: SparkSession, schema: T.StructType, table: str, names: Iterable[str]
) -> DataFrame:
    """Free-text or personal columns that must not reach an output."""
    rows = [("forbidden column", table, c, "must not be stored") for c in names if c in schema.names]
    return spark.createDataFrame(rows, PROBLEM)


def null_problems(rows: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    """Required columns with nulls and how many; one aggregation for all columns."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    long = counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in required])
        ).alias("c")
    ).filter(F.col("c.n") > 0)
    return problems(long, "nulls", table, F.col("c.column"), _text(F.col("c.n"), " null values"))


def duplicate_problems(rows: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    return problems(repeated, "unique", table, key_text(keys), _text(F.col("_n"), " rows"))


def key_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct keys of a table, in one row.

    Two plain aggregations: copies of a hot key combine before the shuffle.
    """
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")
    )


def period_start_problems(
    rows: DataFrame, table: str, keys: Sequence[str], period: str
) -> DataFrame:
    """Periods that are not the first day of a month."""
    bad = rows.filter(F.dayofmonth(period) != 1)
    return problems(bad, "period start", table, key_text(keys), _text("period is ", F.col(period)))


def negative_problems(
    rows: DataFrame, table: str, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Totals and counts below zero."""
    values = F.array(
        *[
            F.when(F.col(c) < 0, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
            for c in columns
        ]
    )
    bad = rows.select(key_text(keys).alias("_key"), F.explode(values).alias("_bad")).filter(
        F.col("_bad").isNotNull()
    )
    detail = _text(F.col("_bad.column"), " is ", F.col("_bad.value"))
    return problems(bad, "negative", table, F.col("_key"), detail)


def rule_problems(
    rows: DataFrame, table: str, keys: Sequence[str], rules: Mapping[str, Column], check: str = "rule"
) -> DataFrame:
    """One problem per row and broken rule; ``rules`` maps a text to the condition that must
    hold. As in SQL, a NULL condition does not break a rule. One scan for all rules."""
    broken = F.filter(
        F.array(*[F.when(~condition, F.lit(name)) for name, condition in rules.items()]),
        lambda name: name.isNotNull(),
    )
    bad = rows.select(key_text(keys).alias("_key"), F.explode(broken).alias("_rule"))
    return problems(bad, check, table, F.col("_key"), F.col("_rule"))


def orphan_problems(
    rows: DataFrame,
    table: str,
    keys: Sequence[str],
    column: str,
    parent: DataFrame,
    parent_key: str,
    check: str = "orphan",
) -> DataFrame:
    """Rows whose reference has no parent row; a NULL reference is allowed.

    References are reduced to the distinct missing ones first, so the hot references do not
    travel through a join keyed by them.
    """
    missing = (
        rows.select(column)
        .filter(F.col(column).isNotNull())
        .distinct()
        .join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
    )
    bad = rows.join(missing, column, "left_semi")
    detail = _text(column, " ", F.col(column), " does not exist")
    return problems(bad, check, table, key_text(keys), detail)


# ------------------------------------------------------------------------------ coherence
def balance_problems(
    balance: DataFrame,
    table: str,
    entity: str,
    period: str,
    names: Sequence[str] = ("total_in", "total_out", "balance", "running_balance"),
) -> DataFrame:
    """balance = in - out, and the running balance is the sum of the balances so far."""
    total_in, total_out, net, running = names
    checked = rollup.running_total(balance, [entity], period, net, "_running").withColumn(
        "_net", (F.col(total_in) - F.col(total_out)).cast(money.MONEY)
    )
    found = F.array(
        F.when(
            ~F.col(net).eqNullSafe(F.col("_net")),
            _text("balance ", F.col(net), ", in minus out ", F.col("_net")),
        ),
        F.when(
            ~F.col(running).eqNullSafe(F.col("_running")),
            _text("running balance ", F.col(running), ", sum so far ", F.col("_running")),
        ),
    )
    bad = checked.select(
        key_text([entity, period]).alias("_key"),
        F.explode(F.filter(found, lambda text: text.isNotNull())).alias("_detail"),
    )
    return problems(bad, "balance", table, F.col("_key"), F.col("_detail"))


def compare_totals(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    check: str,
    table: str,
    sides: Sequence[str] = ("left", "right"),
) -> DataFrame:
    """Keys whose totals differ between two tables; an absent key counts as zeros.

    Both sides are signed and summed in one aggregation, so NULL keys match, rows of one
    key may be split on either side, and one shuffle replaces an outer join.
    """
    def signed(rows: DataFrame, side: int) -> DataFrame:
        pairs = []
        for c in columns:
            pairs.append((F.col(c) if side == 0 else F.lit(0)).alias(f"_l_{c}"))
            pairs.append((F.col(c) if side == 1 else F.lit(0)).alias(f"_r_{c}"))
        return rows.select(*keys, *pairs)

    sums = [F.sum(f"_{s}_{c}").alias(f"_{s}_{c}") for c in columns for s in "lr"]
    compared = signed(left, 0).unionByName(signed(right, 1)).groupBy(*keys).agg(*sums)
    differs = reduce(
        lambda a, b: a | b, [~F.col(f"_l_{c}").eqNullSafe(F.col(f"_r_{c}")) for c in columns]
    )
    show = lambda s: F.concat_ws(" / ", *[F.col(f"_{s}_{c}").cast("string") for c in columns])
    detail = _text(f"{sides[0]} ", show("l"), f", {sides[1]} ", show("r"))
    return problems(compared.filter(differs), check, table, key_text(keys), detail)


def change_problems(
    rows: DataFrame,
    table: str,
    keys: Sequence[str],
    period: str,
    value: str,
    prior: str = "prior_total",
    change: str = "change_pct",
) -> DataFrame:
    """Prior totals or changes that differ from a recomputation by self-join."""
    expected = rollup.period_change_by_join(rows, keys, period, value, prior="_prior", change="_change")
    bad = expected.filter(
        ~F.col(prior).eqNullSafe(F.col("_prior")) | ~F.col(change).eqNullSafe(F.col("_change"))
    )
    detail = _text(
        "prior ", F.col(prior), " expected ", F.col("_prior"),
        ", change ", F.col(change), " expected ", F.col("_change"),
    )
    return problems(bad, "change", table, key_text([*keys, period]), detail)


# ------------------------------------------------------------------------------- outliers
def outlier_rule_problems(
    found: DataFrame, table: str, key: str, amount: str, fences: Fences = Fences()
) -> DataFrame:
    """Internal rules of an outlier table, and unique ids."""
    c = F.col
    extreme, mild = c("severity") == fences.extreme_name, c("severity") == fences.mild_name
    rules = {
        "severity is not valid": extreme | mild,
        "group is too small": c("n_group") >= fences.min_rows,
        "group has no spread": c("iqr") > 0,
        "extreme fence is below the mild fence": c("extreme_fence") >= c("mild_fence"),
        "amount is below the mild fence": c(amount) >= c("mild_fence"),
        "extreme but below the extreme fence": ~extreme | (c(amount) >= c("extreme_fence")),
        "mild but above the extreme fence": ~mild | (c(amount) <= c("extreme_fence")),
        "excess is not amount minus fence": F.abs(c("excess") - (c(amount) - c("mild_fence")))
        <= F.lit(TOLERANCE).cast("decimal(4,2)"),
    }
    broken = rule_problems(found, table, [key], rules, "outlier rule")
    return broken.unionByName(duplicate_problems(found, table, [key]))


def outlier_source_problems(
    found: DataFrame, table: str, key: str, facts: Sequence[str], active: DataFrame
) -> DataFrame:
    """Outliers that are not active rows, or that disagree with them on ``facts``.

    The ids travel, not the rows: ``active`` is reduced to the reported ids by the join.
    """
    source = active.select(F.col(key), F.struct(*facts).alias("_source"))
    joined = found.select(key, F.struct(*facts).alias("_found")).join(source, key, "left")
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"_found.`{f}`").eqNullSafe(F.col(f"_source.`{f}`")) for f in facts],
    )
    missing = F.col("_source").isNull()
    detail = F.when(missing, F.lit("is not an active row")).otherwise(
        F.lit(" or ".join(facts) + " differs from the active row")
    )
    return problems(joined.filter(missing | differs), "outlier source", table, key_text([key]), detail)


def outlier_recompute_problems(
    found: DataFrame, expected: DataFrame, table: str, key: str
) -> DataFrame:
    """Outliers missing from, extra in, or judged otherwise than in a recomputation."""
    reported = found.select(key, F.col("severity").alias("_got"))
    wanted = expected.select(key, F.col("severity").alias("_want"))
    joined = reported.join(wanted, key, "full_outer").filter(
        ~F.col("_got").eqNullSafe(F.col("_want"))
    )
    detail = _text("severity ", F.col("_got"), ", recomputed ", F.col("_want"))
    return problems(joined, "outlier recomputation", table, key_text([key]), detail)


# ---------------------------------------------------------------------------- state gates
def state_problems(
    state: DataFrame,
    table: str,
    keys: Sequence[str],
    not_null: Sequence[str] = (),
    last_op: str = LAST_OP,
) -> DataFrame:
    """Empty table, repeated keys, a delete as last operation, or null amounts."""
    per_key = state.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.count_if(F.col(last_op) == DELETE).alias("_deletes"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in not_null],
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    counted = per_key.agg(
        total("_n").alias("n"),
        (total("_n") - F.count("*")).alias("repeated"),
        total("_deletes").alias("deletes"),
        *[total(f"_null_{c}").alias(f"null_{c}") for c in not_null],
    )
    finding = lambda when, key, detail: F.when(
        when, F.struct(F.lit(key).alias("key"), detail.alias("detail"))
    )
    findings = [
        finding(F.col("n") == 0, "rows", F.lit("table is empty")),
        finding(F.col("repeated") > 0, "key", _text(F.col("repeated"), " repeated rows")),
        finding(F.col("deletes") > 0, last_op, _text(F.col("deletes"), " rows end in a delete")),
        *[
            finding(F.col(f"null_{c}") > 0, c, _text(F.col(f"null_{c}"), " null values"))
            for c in not_null
        ],
    ]
    bad = counted.select(
        F.explode(F.filter(F.array(*findings), lambda f: f.isNotNull())).alias("f")
    )
    return problems(bad, "state", table, F.col("f.key"), F.col("f.detail"))


def total_problems(
    left: DataFrame, right: DataFrame, measures: Mapping[str, tuple[Column, Column]], table: str
) -> DataFrame:
    """Grand totals that differ between two tables; an empty table totals zero."""
    names = list(measures)
    fold = lambda rows, side: rows.agg(
        *[F.coalesce(F.sum(measures[m][side]), F.lit(0)).alias(m) for m in names]
    )
    value = lambda m: F.col(m).cast("decimal(38,2)").alias("v")
    lines = lambda rows: rows.select(
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), value(m)) for m in names])).alias("x")
    ).select("x.measure", "x.v")
    return compare_totals(
        lines(fold(left, 0)), lines(fold(right, 1)), ["measure"], ["v"], "totals", table
    )


# ---------------------------------------------------------------------------- gate, report
def report(found: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """Per check and table: how many problems, the first examples, and how many are not shown.

    Only the ranked first ``limit`` rows of each group are gathered.
    """
    group = ["check", "table"]
    counts = found.groupBy(*group).agg(F.count("*").alias("n_problems"))
    order = Window.partitionBy(*group).orderBy("key", "detail")
    line = F.concat(F.col("key"), F.lit(": "), F.col("detail"))
    first = (
        found.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= limit)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct("_rank", line.alias("line")))).alias("_lines"))
    )
    more = F.col("n_problems") - F.size("_lines")
    text = F.array_join(F.transform("_lines", lambda x: x["line"]), "; ")
    return counts.join(first, group).select(
        *group,
        "n_problems",
        F.when(more > 0, F.concat(text, F.lit("; ... and "), more.cast("string"), F.lit(" more")))
        .otherwise(text)
        .alias("examples"),
    )


def gate(found: DataFrame) -> None:
    """Raise :class:`QualityError` if there is any problem.

    A sound layer is checked once; only a failure computes the report, which has one row per
    check and table.
    """
    if found.isEmpty():
        return
    lines = [
        f"{r['check']} on {r['table']}: {r['n_problems']} ({r['examples']})" for r in report(found).collect()
    ]
    raise QualityError("\n".join(sorted(lines)))
