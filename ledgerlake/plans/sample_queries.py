"""One query per operator over the sample tables.

The checks run over copies of the curated tables in which a rule on the ids plants defects,
so that each of them has something to find.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import money, periods, wire
from ledgerlake.operators import (
    backlog,
    changes,
    latency,
    outliers,
    quality,
    reconcile,
    reports,
    rollup,
)
from ledgerlake.plans import finance, recompute
from ledgerlake.plans import sample_tables as t
from ledgerlake.session import apply_sql_defaults, scratch_dir
from ledgerlake.sinks import publish, segments, warehouse
from ledgerlake.sinks.layers import write_layer
from ledgerlake.sources import events, oplog
from ledgerlake.spec import TableSpec
from ledgerlake.streaming import counts, landing, progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its name; it runs with the SQL defaults of the package."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(apply_sql_defaults(spark), folder)

    QUERIES[function.__name__] = run
    return run


def _millis(*columns: str) -> list[Column]:
    return [F.unix_millis(c).alias(c) for c in columns]


def _every(column: str, n: int) -> Column:
    return F.coalesce(F.col(column) % n == 0, F.lit(False))


def _plant(rows: DataFrame, column: str, where: Column, value: Column) -> DataFrame:
    """Put a wrong value into a column of some rows."""
    kept = F.when(where, value.cast(rows.schema[column].dataType)).otherwise(F.col(column))
    return rows.withColumn(column, kept)


# ------------------------------------------------------------------------ landing, sources
@query
def raw_landing(spark, folder):
    rows = landing.landing_rows(t.messages(t.full_log(spark, folder)), t.TOPIC_PREFIX)
    return rows.select("table", "ingest_date", "topic", "partition", "offset", *_millis("log_ts"), "key", "value")


def _order_stream(spark, folder):
    """The orders as messages of a stream, each at its own date."""
    schema = t.table(spark, folder, "orders").schema
    stream = events.file_events(spark, folder, schema, glob="orders.parquet")
    key = F.col("o_orderkey")
    return stream.select(
        F.lit(f"{t.TOPIC_PREFIX}orders_ledger").alias("topic"),
        (key % 3).cast("int").alias("partition"),
        (key * 3).alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        key.cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("o_custkey", "o_orderstatus", "o_orderpriority")).cast("binary").alias("value"),
    )


def _landed_columns(rows: DataFrame) -> DataFrame:
    return rows.select("table", "ingest_date", "topic", "partition", "offset", *_millis("log_ts"), "key", "value")


@query
def stream_landing(spark, folder):
    """A stream over the orders is landed by date; it then runs again and repeats nothing."""
    path, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "landed-checkpoint")
    rows = landing.clustered(landing.landing_rows(_order_stream(spark, folder), t.TOPIC_PREFIX))
    for _ in range(2):
        landing.drain(landing.start_landing(rows, path, checkpoint))
    return _landed_columns(spark.read.parquet(path))


@query
def segment_landing(spark, folder):
    """The log landed in batches by table and year, put together, and read with what came after."""
    rows = landing.landing_rows(t.messages(t.full_log(spark, folder)), t.TOPIC_PREFIX)
    rows = rows.withColumn("ingest_year", F.year("ingest_date"))
    root, layout, late = scratch_dir(spark, "segments"), ("table", "ingest_year"), F.col("ingest_year") >= 2000
    for number, part in enumerate([~late & (F.col("partition") == 0), ~late & (F.col("partition") != 0), late]):
        if number == 2:
            landing.compact(spark, root, layout)
        landing.land_batch(rows.filter(part), number, root, layout, files=2)
    return _landed_columns(segments.read_segments(spark, root))


@query
def ingest_exclusion(spark, folder):
    """Events of the damaged log that land without the note; unreadable texts land as their digest."""
    rows = landing.landing_rows(t.messages(t.damaged_log(spark, folder)), t.TOPIC_PREFIX)
    landed = landing.exclude_columns(rows, {t.ORDERS_LEDGER.name: ["NOTE"]})
    field = lambda path, name: F.get_json_object("value", f"$.{path}").alias(name)
    return landed.select(
        "partition", "offset", F.col("value").contains("note").alias("has_note"), field("payload.op", "op"),
        field("payload.before.amount", "before_amount"), field("payload.after.id", "after_id"),
        field("payload.after.amount", "after_amount"), field("payload.after.started_at", "after_started_at"),
        field("payload.ts_ms", "ts_ms"), field("unreadable.length", "unreadable_length"), field("unreadable.sha256", "unreadable_sha256"),
    )


@query
def stream_change_summary(spark, folder):
    """Counts kept by a stream over the landed files of the whole log."""
    path = scratch_dir(spark, "log")
    log = t.full_log(spark, folder)
    log.write.parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log.schema.fields)
    target = scratch_dir(spark, "counts")
    stream = counts.running_counts(events.file_events(spark, path, schema))
    landing.drain(counts.start_counts(stream, target, scratch_dir(spark, "counts-checkpoint")))
    return counts.read_counts(spark, target)


@query
def ingest_allowlist(spark, folder):
    """Only the order ledger may enter, and its free text stays out of the state."""
    messages = t.messages(t.full_log(spark, folder))
    landed = landing.landing_rows(messages, t.TOPIC_PREFIX, [t.ORDERS_LEDGER.name])
    spec = TableSpec(t.ORDERS_LEDGER.name, "id BIGINT, owner_id INT, amount DECIMAL(12,2)")
    return changes.current_state(landed, spec).select(*spec.columns)


@query
def oplog_accepted(spark, folder):
    document = F.from_json("document", oplog.OPERATION_LOG)
    documents = t.operation_documents(spark, folder).select(document.alias("d"))
    accepted = oplog.accepted(oplog.operations(documents, F.col("d.operaciones")))
    return accepted.select("row_id", "seq", "op", "sent_ms", "answered_ms", "http")


# ------------------------------------------------------------------------------ change log
@query
def change_log_build(spark, folder):
    return t.order_log(spark, folder).select("table", "ingest_date", "topic", "partition", "offset", "key", "value")


@query
def change_encode(spark, folder):
    """Orders encoded as events and parsed back."""
    events_ = changes.parse_changes(t.order_log(spark, folder), t.ORDERS_LEDGER, before="all")
    typed = lambda side: [
        wire.decode(F.col(f"{side}.{c}"), t.ORDERS_LEDGER.schema[c].dataType).alias(f"{side}_{c}")
        for c in ("id", "amount", "is_inflow", "started_on")
    ]
    return events_.select("offset", "op", *typed("before"), *typed("after"))


@query
def change_parse(spark, folder):
    parsed = changes.parse_changes(t.order_log(spark, folder), t.ORDERS_LEDGER)
    return parsed.select(
        "offset", "partition", "op", F.col("before.id").alias("before_id"),
        *[F.col(f"after.{c}").alias(f"after_{c}") for c in ("id", "amount", "note", "updated_at", "deleted_at")],
    )


@query
def change_quarantine(spark, folder):
    bad = changes.quarantined(t.damaged_log(spark, folder), t.ORDERS_LEDGER)
    return bad.select("offset", "partition", "reason", "value")


@query
def state_with_quarantine(spark, folder):
    """Every event by what becomes of it: usable for the state, or the reason it is set aside."""
    log, place = t.damaged_log(spark, folder), ["offset", "partition", "log_ts"]
    events = changes.parse_changes(log, t.ORDERS_LEDGER).select(*place)
    aside = changes.quarantined(log, t.ORDERS_LEDGER).select(*place, "reason")
    fate = F.coalesce("reason", F.lit("usable")).alias("fate")
    return events.join(aside, place, "left").groupBy(fate).agg(F.count("*").alias("n"))


def _state(spark, folder, mode="strict"):
    log = t.order_log(spark, folder) if mode == "strict" else t.damaged_log(spark, folder)
    return changes.current_state(log, t.ORDERS_LEDGER, mode)


def _state_columns(state: DataFrame) -> DataFrame:
    plain = ["id", "owner_id", "category_id", "amount", "note", "is_inflow", "started_on"]
    return state.select(
        *plain, *_millis("started_at", "updated_at", "deleted_at"),
        F.col(changes.LAST_OFFSET).alias("last_offset"), F.col(changes.LAST_OP).alias("last_op"),
    )


@query
def latest_state(spark, folder):
    return _state_columns(_state(spark, folder))


@query
def latest_state_lenient(spark, folder):
    """State of the damaged log: bad messages neither abort the job nor become rows."""
    return _state_columns(_state(spark, folder, "quarantine"))


@query
def wire_types(spark, folder):
    """Every type from the texts an event may carry for it."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    texts = t.table(spark, folder, "orders").select(
        key.cast("string").alias("id"),
        (key % 1000).cast("string").alias("small"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("amount"),
        F.when(key % 5 == 0, "true").when(key % 5 == 1, "False").when(key % 5 == 2, "1").when(key % 5 == 3, "0")
        .alias("flag"),
        F.when(key % 2 == 0, F.unix_date(day).cast("string")).otherwise(day.cast("string")).alias("day"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string").alias("instant"),
        F.col("o_orderpriority").alias("note"),
    )
    types = {"id": "bigint", "small": "int", "amount": "decimal(12,2)", "flag": "boolean", "day": "date",
             "instant": "timestamp", "note": "string"}
    schema = TableSpec("texts", ", ".join(f"{c} {d}" for c, d in types.items())).schema
    typed = texts.select(*[wire.decode(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])
    return typed.select("id", "small", "amount", F.col("flag").cast("int").alias("flag"), "day",
                        *_millis("instant"), "note")


@query
def change_diff(spark, folder):
    described = changes.describe_changes(t.full_log(spark, folder))
    lines = F.transform(
        F.array_sort(F.map_entries("changes")),
        lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None"))),
    )
    return described.select(
        "offset", "partition", "table", "operation", "row_key", F.array_join(lines, ", ").alias("changes")
    )


@query
def change_summary(spark, folder):
    return changes.change_counts(t.full_log(spark, folder))


@query
def raw_profile(spark, folder):
    return changes.raw_profile(t.full_log(spark, folder))


@query
def state_profile(spark, folder):
    return changes.state_profile(_state(spark, folder), t.ORDERS_LEDGER.name, "deleted_at")


@query
def state_sample(spark, folder):
    """Three rows of each last operation, the same on every run."""
    sample = changes.sample_rows(_state(spark, folder), ["id"], 3, [changes.LAST_OP])
    return sample.select(F.col(changes.LAST_OP).alias("last_op"), "id", "owner_id", "amount")


@query
def state_rebuild(spark, folder):
    """Both captured tables of the log rebuilt, what can't become state set aside; rows of each as written and as read."""
    log = changes.union_logs(t.damaged_log(spark, folder), t.owner_log(spark, folder))
    specs, root = {spec.name: spec for spec in (t.ORDERS_LEDGER, t.OWNERS)}, scratch_dir(spark, "state")
    written = finance.rebuild_state(log, root, "quarantine", quarantine=f"{root}_quarantine", specs=specs)
    layers = {name: f"{root}/{name}" for name in specs} | {f"quarantined {name}": f"{root}_quarantine/{name}" for name in specs}
    stored = quality.all_problems(
        [
            spark.read.parquet(path).agg(F.count("*").alias("n_stored"))
            .select(F.lit(name).alias("layer"), F.lit(written[name]).cast("bigint").alias("n_written"), "n_stored")
            for name, path in layers.items()
        ]
    )
    return stored


@query
def layer_writes(spark, folder):
    """A layer written twice, one written as a single file, one clustered by a column: rows and files of each."""
    balance, root = t.balance(spark, folder).withColumn("year", F.year("period")), scratch_dir(spark, "layers")
    writes = {
        "overwritten": {},
        "single file": {"single_file": True},
        "clustered": {"partition_by": ["year"], "cluster_by": ["year"]},
    }
    parts = []
    for name, how in writes.items():
        for _ in range(2):
            n = write_layer(balance, f"{root}/{name}", **how)
        stored = spark.read.parquet(f"{root}/{name}").withColumn("file", F.input_file_name())
        parts.append(
            stored.agg(F.count("*").alias("n_stored"), F.count_distinct("file").alias("n_files"), F.sum("balance").alias("total"))
            .select(
                F.lit(name).alias("layer"), F.lit(n).cast("bigint").alias("n_written"), "n_stored",
                F.when(F.lit(name) == "single file", F.col("n_files")).alias("n_files"), F.col("total").cast(money.MONEY).alias("total"),
            )
        )
    return quality.all_problems(parts)


@query
def offset_backlog(spark, folder):
    """What the batches committed by the end of 1999 don't cover: owners came later, another topic isn't read."""
    log = t.full_log(spark, folder)
    files = t.offset_files(log.filter(F.col("table") != t.OWNERS.name))
    commits = files.select("batch").filter("batch < 2000")
    landed = progress.last_committed(progress.offsets_in(files), commits)
    ends = backlog.landed_offsets(log)
    foreign = ends.withColumn("topic", F.lit("other.topic"))
    return backlog.offset_backlog(ends.unionByName(foreign), landed, landing.topic_pattern(t.TOPIC_PREFIX))


def _pairs(spark, folder):
    logs = t.operation_logs(spark, folder)
    accepted = oplog.accepted(oplog.operations(logs, F.col("operaciones")))
    captured = latency.live_events(t.order_log(spark, folder), t.ORDERS_LEDGER.name)
    return latency.pair_operations(accepted, captured)


@query
def latency_pairs(spark, folder):
    return _pairs(spark, folder).withColumn("has_event", F.col("has_event").cast("int"))


@query
def latency_unmatched(spark, folder):
    return latency.unmatched(_pairs(spark, folder))


@query
def latency_summary(spark, folder):
    return latency.latency_summary(_pairs(spark, folder), clock_skew_ms=40)


# --------------------------------------------------------------------------------- rollups
@query
def period_bucket(spark, folder):
    rows = t.entries(spark, folder)
    units = [periods.bucket(F.col("started_at"), u).alias(u) for u in ("day", "week", "month", "quarter", "year")]
    return rows.select("entry_id", *units)


@query
def active_rows(spark, folder):
    rows = rollup.active_rows(t.entries(spark, folder), "deleted_at")
    return rows.select("entry_id", "owner_id", "amount")


@query
def period_totals(spark, folder):
    inflows = t.active_entries(spark, folder).filter("is_inflow")
    return rollup.period_totals(inflows, "owner_id", "period", "amount")


@query
def period_balance(spark, folder):
    return rollup.period_balance(
        t.active_entries(spark, folder), "owner_id", "period", "amount", F.col("is_inflow")
    )


@query
def running_balance(spark, folder):
    return t.balance(spark, folder)


@query
def closing_balance(spark, folder):
    return rollup.closing_value(t.balance(spark, folder), "owner_id", "period", "running_balance", "closing_balance")


@query
def category_spend(spark, folder):
    return t.category_spend(spark, folder)


@query
def method_spend(spark, folder):
    return t.method_spend(spark, folder)


@query
def period_change(spark, folder):
    return t.supplier_spend(spark, folder)


@query
def span_profile(spark, folder):
    rows = t.active_entries(spark, folder).withColumn(
        "direction", F.when(F.col("is_inflow"), "in").otherwise("out")
    )
    return rollup.span_profile(rows, "direction", "started_at", "ended_at", "recurrence_id", "category_id")


# -------------------------------------------------------------------------------- outliers
@query
def iqr_stats(spark, folder):
    stats = outliers.judged(outliers.group_fences(t.movements(spark, folder), t.GROUP, "amount"))
    cents = [F.round(c, 2).cast(money.MONEY).alias(c) for c in ("q1", "q3", "iqr", "mild_fence", "extreme_fence")]
    return stats.select(*t.GROUP, "n_group", *cents)


@query
def iqr_outliers(spark, folder):
    return t.found_outliers(spark, folder)


@query
def iqr_stats_sketched(spark, folder):
    """Fences from sketches of every group and month, merged: ranks of the quartiles are within the stated error."""
    rows = t.movements(spark, folder).withColumn("month", F.trunc("occurred_on", "month"))
    merged = outliers.merged_sketches(outliers.quartile_sketches(rows, [*t.GROUP, "month"], "amount"), t.GROUP)
    fences = outliers.sketched_fences(merged, t.GROUP)
    amount, n = F.col("amount"), F.col("n_group")
    placed = rows.join(fences, list(t.GROUP)).groupBy(*t.GROUP, "n_group").agg(
        *[F.count_if(op(amount, F.col(q))).alias(f"{q}_{name}") for q in ("q1", "q3") for name, op in
          (("below", lambda a, b: a < b), ("upto", lambda a, b: a <= b))]
    )
    # One row more, since a rank falls between two rows.
    error = 1 + n * outliers.RANK_ERROR
    fits = lambda q, share: ((F.col(f"{q}_below") - error <= n * share) & (F.col(f"{q}_upto") + error >= n * share)).alias(f"{q}_fits")
    return placed.select(*t.GROUP, "n_group", fits("q1", 0.25), fits("q3", 0.75))


@query
def outlier_summary(spark, folder):
    return outliers.summarise_run(t.movements(spark, folder), t.GROUP, "amount")


@query
def outlier_hotspots(spark, folder):
    return outliers.hotspots(t.found_outliers(spark, folder), ["user_id", "label"])


@query
def outlier_report(spark, folder):
    return reports.outlier_report(t.found_outliers(spark, folder), "event_id").select(
        "event_id", "user_id", "label", "occurred_on", "amount", "mild_fence", "extreme_fence", "excess",
        "severity", "colour",
    )


@query
def top_outliers(spark, folder):
    return reports.top_outliers(t.found_outliers(spark, folder), "event_id", 10).select(
        "event_id", "user_id", "label", "amount", "mild_fence", "excess", "severity"
    )


# --------------------------------------------------------------------------------- reports
@query
def dim_entity(spark, folder):
    return reports.dimension(t.balance(spark, folder), "owner_id")


@query
def dim_period(spark, folder):
    return reports.period_dimension(t.balance(spark, folder), "period")


def _dimensions(spark, folder):
    owners = t.table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    months = reports.dimension(t.balance(spark, folder), "period").filter("period >= DATE'1997-01-01'")
    return {"owner_id": owners.select(F.col("c_custkey").alias("owner_id")), "period": months}


@query
def star_filter(spark, folder):
    """Filtered owners and months applied to a fact table."""
    return reports.filter_by_dimensions(t.category_spend(spark, folder), _dimensions(spark, folder))


@query
def kpi_totals(spark, folder):
    chosen = reports.filter_by_dimensions(t.balance(spark, folder), _dimensions(spark, folder))
    return reports.kpi_totals(chosen, "total_in", "total_out", by=["owner_id"])


@query
def kpi_cards(spark, folder):
    totals = reports.kpi_totals(t.balance(spark, folder), "total_in", "total_out", by=["owner_id"])
    return reports.kpi_cards(totals, ["inflows", "outflows", "net"], by=["owner_id"])


@query
def portfolio_running(spark, folder):
    owners = {"owner_id": _dimensions(spark, folder)["owner_id"]}
    chosen = reports.filter_by_dimensions(t.balance(spark, folder), owners)
    return reports.portfolio_running(chosen, "period", "balance")


@query
def category_by_period(spark, folder):
    return reports.spend_by_period(t.category_spend(spark, folder), "period", "label", "total")


@query
def method_by_period(spark, folder):
    """Months as rows; a column for some payment methods and one for all the others."""
    names = {f"NATION_{i}": f"method_{i}" for i in range(5)} | {t.NO_METHOD: "no_method"}
    return reports.spend_columns(t.method_spend(spark, folder), "period", "label", "total", names, "other_methods")


@query
def change_with_total(spark, folder):
    return reports.change_with_total(t.supplier_spend(spark, folder), "flag", "total", "prior_total", by=["period"])


@query
def change_ranked(spark, folder):
    return reports.change_ranked(t.supplier_spend(spark, folder), "change_pct", ["supplier_id", "flag", "period"])


@query
def entity_period_report(spark, folder):
    return reports.entity_period_report(
        t.supplier_spend(spark, folder), "supplier_id", 5, "period", "2000-04-01", "flag", "total"
    )


@query
def latest_periods(spark, folder):
    return reports.latest_periods(t.balance(spark, folder), "owner_id", "period", 3)


# ---------------------------------------------------------------------------------- checks
@query
def check_nulls(spark, folder):
    rows = _plant(t.balance(spark, folder), "total_in", _every("owner_id", 29), F.lit(None))
    return quality.null_problems(rows, "balance", ["owner_id", "period", "total_in", "total_out"])


@query
def check_contract(spark, folder):
    """The balance against its contract, once a column has another type, one is missing and a name has come in."""
    owners = t.table(spark, folder, "customer").select(F.col("c_custkey").alias("owner_id"), F.col("c_name").alias("name"))
    rows = t.balance(spark, folder).drop("n_out").withColumn("total_in", F.col("total_in").cast("double")).join(owners, "owner_id")
    return quality.all_problems(
        [
            quality.contract_problems(spark, rows.schema, BALANCE_SPEC),
            quality.forbidden_columns(spark, rows.schema, "balance", ["name", "note"]),
            quality.null_problems(rows, "balance", ["owner_id", "period", "name"]),
            quality.duplicate_problems(rows, "balance", ["owner_id"]),
        ]
    )


@query
def check_unique(spark, folder):
    """Line numbers are not unique within an order."""
    lines = t.table(spark, folder, "lineitem")
    return quality.duplicate_problems(lines, "lineitem", ["l_orderkey", "l_linenumber"])


@query
def unique_counts(spark, folder):
    return quality.key_counts(t.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_period_start(spark, folder):
    rows = _plant(t.balance(spark, folder), "period", _every("owner_id", 23), F.date_add("period", 14))
    return quality.period_start_problems(rows, "balance", ["owner_id"], "period")


@query
def check_nonnegative(spark, folder):
    rows = _plant(t.balance(spark, folder), "total_out", _every("owner_id", 41), -F.col("total_out"))
    rows = _plant(rows, "n_in", _every("owner_id", 43), F.lit(-1))
    return quality.negative_problems(
        rows, "balance", ["owner_id", "period"], ["total_in", "total_out", "n_in", "n_out"]
    )


@query
def check_balance(spark, folder):
    rows = _plant(t.balance(spark, folder), "balance", _every("owner_id", 17), F.col("balance") + 1)
    rows = _plant(rows, "running_balance", _every("owner_id", 19), F.col("running_balance") + 1)
    return quality.balance_problems(rows, "balance", "owner_id", "period")


@query
def check_breakdown(spark, folder):
    spend = t.category_spend(spark, folder).filter(~((F.col("category_id") == t.NO_ID) & _every("owner_id", 37)))
    spend = _plant(spend, "total", (F.col("category_id") == 3) & _every("owner_id", 13), F.col("total") + 1)
    balance = t.balance(spark, folder).select(
        "owner_id", "period", F.col("total_out").alias("total"), F.col("n_out").alias("n")
    )
    return quality.compare_totals(
        spend, balance, ["owner_id", "period"], ["total", "n"], "breakdown", "category_spend",
        ("breakdown", "balance"),
    )


@query
def check_change(spark, folder):
    rows = t.supplier_spend(spark, folder)
    rows = _plant(rows, "prior_total", _every("supplier_id", 9), F.col("prior_total") + 1)
    rows = _plant(rows, "change_pct", _every("supplier_id", 11), F.lit("999.99"))
    return quality.change_problems(rows, "supplier_spend", ["supplier_id", "flag"], "period", "total")


BALANCE_SPEC = TableSpec(
    "balance",
    "owner_id BIGINT, period DATE, total_in DECIMAL(18,2), total_out DECIMAL(18,2), balance DECIMAL(18,2), "
    "n_in BIGINT, n_out BIGINT, running_balance DECIMAL(18,2)",
    keys=("owner_id", "period"),
    nullable=(),
)
SPEND_SPEC = TableSpec(
    "category_spend",
    "owner_id BIGINT, period DATE, category_id INT, label STRING, total DECIMAL(18,2), n BIGINT, "
    "prior_total DECIMAL(18,2), change_pct DECIMAL(26,2)",
    keys=("owner_id", "period", "category_id"),
    nullable=("prior_total", "change_pct"),
)


@query
def check_recompute(spark, folder):
    rows = t.category_spend(spark, folder)
    rows = _plant(rows, "total", (F.col("category_id") == 2) & _every("owner_id", 13), F.col("total") + 1)
    expected = recompute.spend(
        t.outflows(spark, folder).select(
            F.col("owner_id").alias("entity"), "period", F.col("category_id").alias("dim_id"), "amount"
        ),
        t.table(spark, folder, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        t.NO_ID,
        t.NO_CATEGORY,
    ).withColumnsRenamed({"entity": "owner_id", "dim_id": "category_id"})
    return reconcile.recompute_problems(rows, expected, "category_spend", SPEND_SPEC)


@query
def check_outlier_rules(spark, folder):
    rows = t.found_outliers(spark, folder)
    rows = _plant(rows, "severity", _every("event_id", 5), F.lit("grave"))
    rows = _plant(rows, "n_group", _every("event_id", 7), F.lit(3))
    rows = _plant(rows, "amount", _every("event_id", 11), F.col("mild_fence") - 1)
    rows = _plant(rows, "iqr", _every("event_id", 13), F.lit(0))
    again = rows.filter(_every("event_id", 4))
    return quality.outlier_rule_problems(rows.unionByName(again), "outliers", "event_id", "amount")


@query
def check_outlier_orphans(spark, folder):
    rows = t.found_outliers(spark, folder)
    rows = _plant(rows, "amount", _every("event_id", 7), F.col("amount") + 1)
    rows = _plant(rows, "event_id", _every("event_id", 11), -F.col("event_id") - 1)
    active = t.movements(spark, folder)
    return quality.outlier_source_problems(rows, "outliers", "event_id", ["user_id", "amount"], active)


@query
def check_outlier_recompute(spark, folder):
    """Against the same table in separate SQL."""
    rows = t.found_outliers(spark, folder).filter(~_every("event_id", 5))
    rows = _plant(rows, "severity", _every("event_id", 7), F.lit(outliers.EXTREME))
    neutral = t.movements(spark, folder).selectExpr("event_id AS id", "user_id AS entity", "category_id AS dim_id", "amount")
    fences = outliers.Fences()
    expected = recompute.outliers(
        neutral, fences.min_rows, fences.mild, fences.extreme, fences.mild_name, fences.extreme_name
    ).withColumnRenamed("id", "event_id")
    return quality.outlier_recompute_problems(rows, expected, "outliers", "event_id")


@query
def check_state(spark, folder):
    state = _state(spark, folder)
    state = _plant(state, changes.LAST_OP, _every("id", 501), F.lit("d"))
    state = _plant(state, "amount", _every("id", 403), F.lit(None))
    state = state.unionByName(state.filter(_every("id", 307)))
    bad = quality.state_problems(state, t.ORDERS_LEDGER.name, ["id"], ["amount"])
    empty = quality.state_problems(state.filter("id < 0"), "empty_ledger", ["id"], ["amount"])
    return bad.unionByName(empty)


@query
def check_totals(spark, folder):
    """Curated totals against the active state; the outflows are planted one off per owner."""
    active = t.active_entries(spark, folder)
    wrong = _plant(t.balance(spark, folder), "total_out", _every("owner_id", 13), F.col("total_out") + 1)
    zero = F.lit(0).cast("decimal(12,2)")
    return quality.total_problems(
        wrong,
        active,
        {
            "inflows": (F.col("total_in"), F.when(F.col("is_inflow"), F.col("amount")).otherwise(zero)),
            "outflows": (F.col("total_out"), F.when(~F.col("is_inflow"), F.col("amount")).otherwise(zero)),
        },
        "balance",
    )


@query
def check_ranges(spark, folder):
    rules = {
        "amount must be at least 1000.00": F.col("amount") >= 1000,
        "amount must be below 490000.00": F.col("amount") < 490000,
        "an entry ends after it starts": F.col("ended_at") > F.col("started_at"),
    }
    return quality.rule_problems(t.entries(spark, folder), "entries", ["entry_id"], rules, "range")


@query
def check_orphans(spark, folder):
    return quality.orphan_problems(
        t.entries(spark, folder), "entries", ["entry_id"], "category_id",
        t.table(spark, folder, "region"), "r_regionkey",
    )


@query
def check_report(spark, folder):
    """The orphan and duplicate checks as a report with capped examples."""
    return quality.report(check_orphans(spark, folder).unionByName(check_unique(spark, folder)))


@query
def check_gate(spark, folder):
    """What a gate says when it stops a run over the same problems; one line per check and table."""
    try:
        quality.gate(check_orphans(spark, folder).unionByName(check_unique(spark, folder)))
        lines = []
    except quality.QualityError as error:
        lines = str(error).split("\n")
    return spark.createDataFrame([(line,) for line in lines], "line STRING")


# -------------------------------------------------------------------------- reconciliation
@query
def recon_counts(spark, folder):
    """The state lacks the deleted orders that the base table still has."""
    lake = {
        "orders_ledger": _state(spark, folder),
        "owners": changes.current_state(t.owner_log(spark, folder), t.OWNERS),
    }
    source = {
        "orders_ledger": t.table(spark, folder, "orders"),
        "owners": t.table(spark, folder, "customer"),
    }
    return reconcile.count_problems(reconcile.row_counts(lake), reconcile.row_counts(source))


@query
def recon_totals(spark, folder):
    source = _plant(t.entries(spark, folder), "amount", _every("entry_id", 1000), F.col("amount") + 1)
    totals = reconcile.source_totals(source.filter("is_inflow"), "owner_id", "started_at", "amount", "deleted_at")
    return reconcile.total_problems(
        t.balance(spark, folder), "owner_id", "period", "total_in", "n_in", totals, "balance"
    )


@query
def multiset_diff(spark, folder):
    """Orders against their state: updated amounts and deleted rows differ."""
    columns = ["id", "owner_id", "amount"]
    orders = t.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("int").alias("owner_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )
    return reconcile.multiset_diff(orders, _state(spark, folder), columns)


@query
def warehouse_check(spark, folder):
    """The balance loaded into a warehouse table, which then loses and gains rows, against what was loaded."""
    dataset = f"marts_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {dataset} LOCATION '{scratch_dir(spark, 'warehouse')}'")
    balance, specs = t.balance(spark, folder), {"balance": BALANCE_SPEC}
    warehouse.load_tables(spark, {"balance": balance}, specs, dataset)
    quality.gate(warehouse.loaded_problems(spark, {"balance": balance}, specs, dataset))
    # What was published since: some owners' balances differ from what the warehouse still has.
    later = _plant(balance, "balance", _every("owner_id", 31), F.col("balance") + 1)
    return warehouse.loaded_problems(spark, {"balance": later}, specs, dataset)


def _published(spark, folder) -> str:
    root = scratch_dir(spark, "published")
    publish.publish({"balance": t.balance(spark, folder), "category_spend": t.category_spend(spark, folder)}, root)
    return root


@query
def publish_manifest(spark, folder):
    """Balance and category spend, published, verified and read back from the manifest."""
    return publish.latest_manifest(spark, _published(spark, folder)).select("table", "n_rows", "digest")


@query
def publish_plan(spark, folder):
    """Rows that a publication of two layers would copy, from their files' footers."""
    root = scratch_dir(spark, "curated")
    for name, rows in (("balance", t.balance(spark, folder)), ("category_spend", t.category_spend(spark, folder))):
        write_layer(rows, f"{root}/{name}")
    planned = publish.plan(spark, root, {"balance": "target/balance", "category_spend": "target/category_spend"})
    return planned.select("table", "target", "n_rows", (F.col("n_files") > 0).alias("has_files"), (F.col("n_bytes") > 0).alias("has_bytes"))


@query
def publish_retention(spark, folder):
    """Three publications of which the last two stay; content and files of the last are as listed."""
    root = scratch_dir(spark, "published")
    balance = t.balance(spark, folder)
    runs = [publish.publish({"balance": balance.filter(F.col("owner_id") % 3 >= n)}, root) for n in (2, 1, 0)]
    gone = publish.expire(spark, root, keep=2, older_than=timedelta(0))
    problems = publish.file_problems(spark, root).unionByName(publish.verify_published(spark, root))
    kept = publish.read_published(spark, root, "balance").agg(F.count("*").alias("n_rows"), F.sum("balance").cast(money.MONEY).alias("total"))
    return kept.select("n_rows", "total", F.lit(gone == runs[:1]).alias("first_is_gone"), F.lit(problems.isEmpty()).alias("files_are_whole"))
