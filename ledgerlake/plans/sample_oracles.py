"""The sample queries in plain SQL, written for DuckDB over the same Parquet tables."""

from __future__ import annotations


def _with(*names: str, body: str) -> str:
    return "WITH " + ",\n".join(_CTE[n] for n in names) + "\n" + body


# --------------------------------------------------------------------------- shared tables
def _spend_cte(name: str, source: str, keys: str, dim: str) -> str:
    """Totals with the previous calendar month by self-join, and the change in exact integers."""
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    return f"""{name}_totals AS (
  SELECT {keys}, period, CAST(sum(amount) AS DECIMAL(18,2)) AS total, count(*) AS n
  FROM {source} GROUP BY {keys}, period),
{name}_prior AS (
  SELECT a.*, b.total AS prior_total,
         CAST((a.total - b.total) * 100 AS HUGEINT) * 10000 AS num, CAST(b.total * 100 AS HUGEINT) AS den
  FROM {name}_totals a LEFT JOIN {name}_totals b
    ON {on} AND b.period = CAST(a.period - INTERVAL 1 MONTH AS DATE)),
{name} AS (
  SELECT {keys}, period, total, n, prior_total, {_percent("num", "den")} AS change_pct
  FROM {name}_prior)"""


def _percent(num: str, den: str) -> str:
    """``num / den`` hundredths, half away from zero, as DECIMAL(26,2)."""
    rounded = f"sign({num}) * ((2 * abs({num}) + {den}) // (2 * {den}))"
    return (
        f"CASE WHEN {den} <> 0 THEN CAST({rounded} AS DECIMAL(24,0)) * CAST(0.01 AS DECIMAL(2,2)) END"
    )


def _row_json(amount: str, updated: str, deleted: str) -> str:
    return (
        "'{\"id\":' || id || ',\"owner_id\":' || owner_id || ',\"category_id\":' || "
        "coalesce(CAST(category_id AS VARCHAR), 'null') || ',\"amount\":\"' || "
        f"CAST({amount} AS DECIMAL(12,2)) || '\",\"note\":\"' || note || '\",\"is_inflow\":' || "
        "CAST(is_inflow AS INTEGER) || ',\"started_on\":' || (CAST(ts AS DATE) - DATE '1970-01-01') || "
        f"',\"started_at\":' || epoch_ms(ts) || ',\"updated_at\":' || epoch_ms({updated}) || "
        f"',\"deleted_at\":' || coalesce(CAST(epoch_ms({deleted}) AS VARCHAR), 'null') || '}}'"
    )


def _event(table: str, source: str, where: str, op: str, step: int, before: str, after: str, days: int) -> str:
    instant = f"(ts + INTERVAL {days} DAY)"
    value = (
        f"'{{\"payload\":{{\"op\":\"{op}\",\"before\":' || {before} || ',\"after\":' || {after} || "
        f"',\"source\":{{\"table\":\"{table}\",\"ts_ms\":' || epoch_ms({instant}) || '}},\"ts_ms\":' || "
        f"(epoch_ms({instant}) + 100 + id % 900) || '}}}}'"
    )
    return _message(table, source, where, step, value, instant)


def _message(table: str, source: str, where: str, step: int, value: str, instant: str = "ts") -> str:
    return (
        f"SELECT '{table}' AS \"table\", CAST({instant} AS DATE) AS ingest_date, "
        f"'lake.ledger.{table}' AS topic, CAST(id % 3 AS INTEGER) AS \"partition\", "
        f"id * 16 + {step} AS \"offset\", {instant} AS log_ts, CAST(id AS VARCHAR) AS \"key\", "
        f"{value} AS value FROM {source} WHERE {where}"
    )


_ORIGINAL = _row_json("amount", "ts", "CAST(NULL AS TIMESTAMP)")
_DEARER = _row_json("amount + 1.25", "ts + INTERVAL 1 DAY", "CAST(NULL AS TIMESTAMP)")
_HIDDEN = _row_json("amount", "ts + INTERVAL 1 DAY", "ts + INTERVAL 1 DAY")
_OWNER = "'{\"id\":' || id || ',\"name\":\"' || name || '\",\"segment\":\"' || segment || '\"}'"
_LEDGER = "orders_ledger"

_ORDER_EVENTS = "\n  UNION ALL ".join(
    [
        _event(_LEDGER, "order_rows", "true", "c", 0, "'null'", _ORIGINAL, 0),
        _event(_LEDGER, "order_rows", "id % 6 = 1", "u", 1, _ORIGINAL, _DEARER, 1),
        _event(_LEDGER, "order_rows", "id % 12 = 5", "u", 2, _ORIGINAL, _HIDDEN, 1),
        _event(_LEDGER, "order_rows", "id % 18 = 3", "d", 3, _ORIGINAL, "'null'", 2),
        _message(_LEDGER, "order_rows", "id % 18 = 3", 4, "CAST(NULL AS VARCHAR)", "(ts + INTERVAL 2 DAY)"),
    ]
)
_DAMAGE = "\n  UNION ALL ".join(
    [
        _message(_LEDGER, "order_rows", "id % 97 = 0", 5, "'{\"payload\":{\"op\":\"u\",\"after\":{\"id\":' || id"),
        _message(_LEDGER, "order_rows", "id % 101 = 0", 6, "'{\"payload\":null}'"),
        _message(
            _LEDGER, "order_rows", "id % 103 = 0", 7,
            "'{\"payload\":{\"op\":\"c\",\"before\":null,\"after\":{\"note\":\"lost\"}}}'",
        ),
        _message(
            _LEDGER, "order_rows", "id % 107 = 0", 8,
            "'{\"payload\":{\"op\":\"u\",\"before\":null,\"after\":{\"id\":' || id || ',\"amount\":\"12,50\"}}}'",
        ),
    ]
)


def _after(column: str) -> str:
    return f"json_extract_string(value, '$.payload.after.{column}')"


def _state_cte(name: str, log: str) -> str:
    return f"""{name}_events AS (
  SELECT CAST(coalesce({_after("id")}, json_extract_string(value, '$.payload.before.id')) AS BIGINT) AS id,
         json_extract_string(value, '$.payload.op') AS op, "offset", value
  FROM (SELECT "offset", CASE WHEN json_valid(value) THEN value END AS value FROM {log} WHERE "table" = '{_LEDGER}')
  WHERE value IS NOT NULL),
{name}_last AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY "offset" DESC) AS rn
  FROM {name}_events WHERE op IS NOT NULL AND id IS NOT NULL AND (op = 'd' OR {_after("amount")} NOT LIKE '%,%')),
{name} AS (
  SELECT id, CAST({_after("owner_id")} AS INTEGER) AS owner_id,
         CAST({_after("category_id")} AS INTEGER) AS category_id,
         TRY_CAST({_after("amount")} AS DECIMAL(12,2)) AS amount, {_after("note")} AS note,
         CASE {_after("is_inflow")} WHEN '1' THEN true WHEN '0' THEN false END AS is_inflow,
         DATE '1970-01-01' + CAST({_after("started_on")} AS INTEGER) AS started_on,
         CAST({_after("started_at")} AS BIGINT) AS started_at,
         CAST({_after("updated_at")} AS BIGINT) AS updated_at,
         CAST({_after("deleted_at")} AS BIGINT) AS deleted_at, "offset" AS last_offset, op AS last_op
  FROM {name}_last WHERE rn = 1 AND op <> 'd')"""


_QUARTILES = """
  SELECT user_id, category_id, count(*) AS n_group,
         CAST(CAST(quantile_cont(CAST(CAST(amount * 100 AS BIGINT) AS DOUBLE), 0.25) * 4 AS DECIMAL(18,0))
              * CAST(0.0025 AS DECIMAL(4,4)) AS DECIMAL(18,4)) AS q1,
         CAST(CAST(quantile_cont(CAST(CAST(amount * 100 AS BIGINT) AS DOUBLE), 0.75) * 4 AS DECIMAL(18,0))
              * CAST(0.0025 AS DECIMAL(4,4)) AS DECIMAL(18,4)) AS q3
  FROM movements GROUP BY user_id, category_id"""

_MONEY_FENCES = ", ".join(
    f"CAST({c} AS DECIMAL(18,2)) AS {c}" for c in ("q1", "q3", "iqr", "mild_fence", "extreme_fence")
)

_CTE = {
    "entries": """entries AS (
  SELECT o_orderkey AS entry_id, o_custkey AS owner_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         o_orderstatus = 'F' AS is_inflow,
         CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_custkey % 6 AS INTEGER) END AS category_id,
         CASE WHEN o_orderkey % 19 <> 7 THEN CAST(o_orderkey % 30 AS INTEGER) END AS method_id,
         CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS recurrence_id,
         o_orderdate AS started_at,
         CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + to_days(CAST(o_orderkey % 45 AS INTEGER)) END AS ended_at,
         CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate + INTERVAL 1 DAY END AS deleted_at
  FROM orders)""",
    "active": """active AS (
  SELECT *, CAST(date_trunc('month', started_at) AS DATE) AS period FROM entries WHERE deleted_at IS NULL)""",
    "balance": """balance_base AS (
  SELECT owner_id, period,
         CAST(coalesce(sum(amount) FILTER (WHERE is_inflow), 0) AS DECIMAL(18,2)) AS total_in,
         CAST(coalesce(sum(amount) FILTER (WHERE NOT is_inflow), 0) AS DECIMAL(18,2)) AS total_out,
         count(*) FILTER (WHERE is_inflow) AS n_in, count(*) FILTER (WHERE NOT is_inflow) AS n_out
  FROM active GROUP BY owner_id, period),
balance AS (
  SELECT owner_id, period, total_in, total_out, CAST(total_in - total_out AS DECIMAL(18,2)) AS balance,
         n_in, n_out,
         CAST(sum(total_in - total_out) OVER (PARTITION BY owner_id ORDER BY period
              ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS running_balance
  FROM balance_base)""",
    "category_spend": "category_out AS (SELECT owner_id, coalesce(category_id, -1) AS category_id, period, amount "
    "FROM active WHERE NOT is_inflow),\n"
    + _spend_cte("category_change", "category_out", "owner_id, category_id", "category_id")
    + """,
category_spend AS (
  SELECT c.*, coalesce(r_name, 'No category') AS label
  FROM category_change c LEFT JOIN region ON r_regionkey = category_id)""",
    "method_spend": "method_out AS (SELECT owner_id, coalesce(method_id, -1) AS method_id, period, amount "
    "FROM active WHERE NOT is_inflow),\n"
    + _spend_cte("method_change", "method_out", "owner_id, method_id", "method_id")
    + """,
method_spend AS (
  SELECT c.*, coalesce(n_name, 'No method') AS label
  FROM method_change c LEFT JOIN nation ON n_nationkey = method_id)""",
    "supplier_spend": """lines AS (
  SELECT l_suppkey AS supplier_id, l_returnflag AS flag, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS period FROM lineitem),
"""
    + _spend_cte("supplier_spend", "lines", "supplier_id, flag", "flag"),
    "movements": """movements AS (
  SELECT event_id, user_id,
         CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 7
              ELSE -1 END AS category_id,
         CAST(value AS DECIMAL(12,2)) AS amount, CAST(ts AS DATE) AS occurred_on
  FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) % 17 <> 0)""",
    "stats": f"""quartiles AS ({_QUARTILES}),
stats AS (
  SELECT *, q3 - q1 AS iqr, q3 + 1.5 * (q3 - q1) AS mild_fence, q3 + 3.0 * (q3 - q1) AS extreme_fence
  FROM quartiles)""",
    "found": f"""found AS (
  SELECT m.event_id, m.user_id, m.category_id, coalesce(r_name, 'No category') AS label, m.occurred_on,
         m.amount, n_group, {_MONEY_FENCES},
         CAST(m.amount - mild_fence AS DECIMAL(18,2)) AS excess,
         CASE WHEN m.amount > extreme_fence THEN 'extreme' ELSE 'mild' END AS severity
  FROM movements m JOIN stats s ON m.user_id = s.user_id AND m.category_id = s.category_id
  LEFT JOIN region ON r_regionkey = m.category_id
  WHERE n_group >= 8 AND iqr > 0 AND m.amount > mild_fence)""",
    "order_rows": """order_rows AS (
  SELECT o_orderkey AS id, CAST(o_custkey AS INTEGER) AS owner_id,
         CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_custkey % 6 AS INTEGER) END AS category_id,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount, 'order ' || o_orderkey AS note,
         o_orderstatus = 'F' AS is_inflow, o_orderdate AS ts FROM orders)""",
    "order_log": f"order_log AS ({_ORDER_EVENTS})",
    "owner_log": """owner_rows AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, TIMESTAMP '1995-01-01 00:00:00' AS ts
  FROM customer),
owner_log AS ("""
    + _event("owners", "owner_rows", "true", "r", 0, "'null'", _OWNER, 0)
    + ")",
    "full_log": "full_log AS (SELECT * FROM order_log UNION ALL SELECT * FROM owner_log)",
    "damaged_log": f"damaged_log AS (SELECT * FROM order_log UNION ALL {_DAMAGE})",
    "state": _state_cte("state", "order_log"),
    "lenient_state": _state_cte("lenient_state", "damaged_log"),
    "accepted": """calls AS (
  SELECT o_orderkey AS row_id, 'crear' AS op, 0 AS days, 0 AS rnk,
         CASE WHEN o_orderkey % 13 = 0 THEN 500 ELSE 201 END AS http, o_orderdate AS ts FROM orders
  UNION ALL SELECT o_orderkey, 'actualizar', 1, 1, 200, o_orderdate FROM orders WHERE o_orderkey % 6 = 1
  UNION ALL SELECT o_orderkey, 'eliminar', 2, 2, 204, o_orderdate FROM orders WHERE o_orderkey % 29 = 0),
accepted AS (
  SELECT row_id, seq, op, epoch_ms(ts) + days * 86400000 - row_id % 50 AS sent_ms,
         epoch_ms(ts) + days * 86400000 - row_id % 50 + 20 + row_id % 30 AS answered_ms, http
  FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY rnk) - 1 AS seq FROM calls)
  WHERE http >= 200 AND http < 300)""",
    "pairs": """captured AS (
  SELECT CAST(coalesce(json_extract_string(value, '$.payload.after.id'),
                       json_extract_string(value, '$.payload.before.id')) AS BIGINT) AS row_id, "offset",
         json_extract_string(value, '$.payload.op') AS event_op,
         CAST(json_extract_string(value, '$.payload.ts_ms') AS BIGINT) AS emitted_ms,
         CAST(json_extract_string(value, '$.payload.source.ts_ms') AS BIGINT) AS source_ms
  FROM order_log WHERE value IS NOT NULL),
numbered_events AS (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY "offset") AS ordinal FROM captured
  WHERE event_op IN ('c', 'u', 'd') AND row_id IN (SELECT row_id FROM accepted)),
numbered_calls AS (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY sent_ms, seq) AS ordinal FROM accepted),
pairs AS (
  SELECT c.row_id, c.ordinal, c.op, e.event_op, e.emitted_ms - c.sent_ms AS sent_to_emit_ms,
         e.emitted_ms - c.answered_ms AS answer_to_emit_ms, e.emitted_ms - e.source_ms AS source_to_emit_ms,
         CAST(e.row_id IS NOT NULL AS INTEGER) AS has_event
  FROM numbered_calls c LEFT JOIN numbered_events e ON c.row_id = e.row_id AND c.ordinal = e.ordinal)""",
    "chosen_owners": "chosen_owners AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
}

_LEDGER_BASE = ("entries", "active")
_BALANCE = (*_LEDGER_BASE, "balance")
_SPEND = (*_LEDGER_BASE, "category_spend")
_FOUND = ("movements", "stats", "found")
_ORDER_LOG = ("order_rows", "order_log")
_FULL_LOG = (*_ORDER_LOG, "owner_log", "full_log")
_PAIRS = (*_ORDER_LOG, "accepted", "pairs")


def _problem(check: str, table: str, key: str, detail: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST({key} AS VARCHAR) AS \"key\", "
        f"{detail} AS detail FROM {source}"
    )


def _text(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'NULL')"


def _union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


_OP_LABEL = "CASE op WHEN 'r' THEN 'SNAPSHOT' WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' END"
_OP = "json_extract_string(value, '$.payload.op')"
_CHANGE_COUNTS = f"""SELECT "table", {_OP_LABEL} AS operation, count(*) AS n
FROM (SELECT "table", {_OP} AS op FROM full_log WHERE value IS NOT NULL) GROUP BY 1, 2"""

_FIELDS = sorted(
    ["id", "owner_id", "category_id", "amount", "note", "is_inflow", "started_on", "started_at", "updated_at",
     "deleted_at"]
)


def _changes_text() -> str:
    def side(name: str, field: str) -> str:
        return f"json_extract_string(value, '$.payload.{name}.{field}')"

    def shown(text: str) -> str:
        return f"coalesce({text}, 'None')"

    updates = ", ".join(
        f"CASE WHEN {side('before', f)} IS DISTINCT FROM {side('after', f)} "
        f"THEN '{f}: ' || {shown(side('before', f))} || ' -> ' || {shown(side('after', f))} END"
        for f in _FIELDS
    )
    rows = ", ".join(
        f"'{f}: ' || {shown('coalesce(' + side('after', f) + ', ' + side('before', f) + ')')}" for f in _FIELDS
    )
    return (
        f"CASE WHEN {_OP} = 'u' THEN array_to_string(list_filter([{updates}], lambda x: x IS NOT NULL), ', ') "
        f"WHEN {_OP} IN ('c', 'd') THEN array_to_string([{rows}], ', ') END"
    )


def _percentiles(column: str, name: str) -> str:
    return f"""SELECT '{name}' AS measure, count(v) AS n, min(v) AS min_ms,
  CAST(round_even(median(v), 0) AS BIGINT) AS median_ms,
  quantile_disc(v, 0.95) AS p95_ms, max(v) AS max_ms FROM (SELECT {column} AS v FROM pairs) HAVING count(v) > 0"""


_STATE_COLUMNS = (
    "id, owner_id, category_id, amount, note, is_inflow, started_on, started_at, updated_at, deleted_at, "
    "last_offset, last_op"
)

_CHECK_ORPHANS = _problem(
    "orphan", "entries", "entry_id", "'category_id ' || category_id || ' does not exist'",
    "entries WHERE category_id IS NOT NULL AND category_id NOT IN (SELECT r_regionkey FROM region)",
)
_CHECK_UNIQUE = _problem(
    "unique", "lineitem", "l_orderkey || '|' || l_linenumber", "n || ' rows'",
    "(SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)",
)

# Planted defects, as in the queries.
_PLANTED_BALANCE = """planted AS (
  SELECT owner_id, period, total_in, total_out, running_balance
           + CASE WHEN owner_id % 19 = 0 THEN 1 ELSE 0 END AS running_balance,
         balance + CASE WHEN owner_id % 17 = 0 THEN 1 ELSE 0 END AS balance FROM balance),
checked AS (
  SELECT *, CAST(total_in - total_out AS DECIMAL(18,2)) AS net,
         CAST(sum(balance) OVER (PARTITION BY owner_id ORDER BY period ROWS UNBOUNDED PRECEDING)
              AS DECIMAL(18,2)) AS so_far FROM planted)
"""
_PLANTED_OUTLIERS = """planted AS (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'grave' ELSE severity END AS severity,
         CASE WHEN event_id % 7 = 0 THEN 3 ELSE n_group END AS n_group,
         CASE WHEN event_id % 11 = 0 THEN mild_fence - 1 ELSE amount END AS amount,
         CASE WHEN event_id % 13 = 0 THEN 0 ELSE iqr END AS iqr, mild_fence, extreme_fence, excess FROM found),
doubled AS (SELECT * FROM planted UNION ALL SELECT * FROM planted WHERE event_id % 4 = 0)
"""
_OUTLIER_RULES = {
    "severity is not valid": "severity NOT IN ('mild', 'extreme')",
    "group is too small": "n_group < 8",
    "group has no spread": "iqr <= 0",
    "extreme fence is below the mild fence": "extreme_fence < mild_fence",
    "amount is below the mild fence": "amount < mild_fence",
    "extreme but below the extreme fence": "severity = 'extreme' AND amount < extreme_fence",
    "mild but above the extreme fence": "severity = 'mild' AND amount > extreme_fence",
    "excess is not amount minus fence": "abs(excess - (amount - mild_fence)) > 0.01",
}
_RANGE_RULES = {
    "amount must be at least 1000.00": "amount < 1000",
    "amount must be below 490000.00": "amount >= 490000",
    "an entry ends after it starts": "ended_at <= started_at",
}


def _digest(columns: list[str]) -> str:
    text = lambda c: f"CAST({c} AS VARCHAR)"
    parts = " || ".join(f"coalesce(length({text(c)}) || ':' || {text(c)}, '-') || ','" for c in columns)
    row = f"CAST(CAST('0x' || substr(md5({parts}), 1, 15) AS BIGINT) AS DECIMAL(28,0))"
    return f"CAST(sum({row}) AS DECIMAL(38,0))"


_BALANCE_COLUMNS = ["owner_id", "period", "total_in", "total_out", "balance", "n_in", "n_out", "running_balance"]
_SPEND_COLUMNS = ["category_id", "owner_id", "period", "total", "n", "prior_total", "change_pct", "label"]

ORACLES = {
    # ---------------------------------------------------------------------- landing, sources
    "raw_landing": _with(
        *_FULL_LOG,
        body='SELECT "table", ingest_date, topic, "partition", "offset", epoch_ms(log_ts) AS log_ts, "key", value '
        "FROM full_log",
    ),
    "stream_landing": """SELECT 'orders_ledger' AS "table", CAST(o_orderdate AS DATE) AS ingest_date,
  'lake.ledger.orders_ledger' AS topic, CAST(o_orderkey % 3 AS INTEGER) AS "partition",
  o_orderkey * 3 AS "offset", epoch_ms(o_orderdate) AS log_ts,
  CAST(o_orderkey AS VARCHAR) AS "key",
  '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"'
    || o_orderpriority || '"}' AS value FROM orders""",
    "segment_landing": _with(
        *_FULL_LOG,
        body='SELECT "table", ingest_date, topic, "partition", "offset", epoch_ms(log_ts) AS log_ts, "key", value '
        "FROM full_log",
    ),
    "ingest_exclusion": _with(
        *_ORDER_LOG, "damaged_log",
        body="""SELECT "partition", "offset", CASE WHEN value IS NOT NULL THEN false END AS has_note,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload.op') END AS op,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload.before.amount') END AS before_amount,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload.after.id') END AS after_id,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload.after.amount') END AS after_amount,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload.after.started_at') END AS after_started_at,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload.ts_ms') END AS ts_ms,
  CASE WHEN NOT json_valid(value) OR value = '{"payload":null}' THEN CAST(length(value) AS VARCHAR) END AS unreadable_length,
  CASE WHEN NOT json_valid(value) OR value = '{"payload":null}' THEN sha256(value) END AS unreadable_sha256
FROM damaged_log""",
    ),
    "stream_change_summary": _with(*_FULL_LOG, body=_CHANGE_COUNTS),
    "ingest_allowlist": _with(*_ORDER_LOG, "state", body="SELECT id, owner_id, amount FROM state"),
    "oplog_accepted": _with("accepted", body="SELECT row_id, seq, op, sent_ms, answered_ms, http FROM accepted"),
    # -------------------------------------------------------------------------- change log
    "change_log_build": _with(
        *_ORDER_LOG,
        body='SELECT "table", ingest_date, topic, "partition", "offset", "key", value FROM order_log',
    ),
    "change_encode": _with(
        "order_rows",
        body="""SELECT id * 16 AS "offset", 'c' AS op, NULL::BIGINT AS before_id,
  NULL::DECIMAL(12,2) AS before_amount, NULL::BOOLEAN AS before_is_inflow, NULL::DATE AS before_started_on,
  id AS after_id, amount AS after_amount, is_inflow AS after_is_inflow, CAST(ts AS DATE) AS after_started_on
FROM order_rows
UNION ALL SELECT id * 16 + CASE WHEN id % 6 = 1 THEN 1 ELSE 2 END, 'u', id, amount, is_inflow, CAST(ts AS DATE), id,
  CAST(amount + CASE WHEN id % 6 = 1 THEN 1.25 ELSE 0 END AS DECIMAL(12,2)), is_inflow, CAST(ts AS DATE)
FROM order_rows WHERE id % 6 = 1 OR id % 12 = 5
UNION ALL SELECT id * 16 + 3, 'd', id, amount, is_inflow, CAST(ts AS DATE), NULL, NULL, NULL, NULL
FROM order_rows WHERE id % 18 = 3""",
    ),
    "change_parse": _with(
        *_ORDER_LOG,
        body=f"""SELECT "offset", "partition", {_OP} AS op,
  json_extract_string(value, '$.payload.before.id') AS before_id, {_after("id")} AS after_id,
  {_after("amount")} AS after_amount, {_after("note")} AS after_note, {_after("updated_at")} AS after_updated_at,
  {_after("deleted_at")} AS after_deleted_at FROM order_log WHERE value IS NOT NULL""",
    ),
    "change_quarantine": _with(
        "order_rows",
        body=f"""SELECT "offset", "partition",
  CASE ("offset" - CAST("key" AS BIGINT) * 16) WHEN 5 THEN 'unreadable envelope' WHEN 6 THEN 'unreadable envelope'
       WHEN 7 THEN 'missing key' ELSE 'bad value: amount' END AS reason, value FROM ({_DAMAGE})""",
    ),
    "state_with_quarantine": _with(
        *_ORDER_LOG,
        body=f"""SELECT 'usable' AS fate, count(*) AS n FROM order_log WHERE value IS NOT NULL
UNION ALL
SELECT CASE "offset" - CAST("key" AS BIGINT) * 16 WHEN 5 THEN 'unreadable envelope' WHEN 6 THEN 'unreadable envelope'
       WHEN 7 THEN 'missing key' ELSE 'bad value: amount' END AS fate, count(*) AS n
FROM ({_DAMAGE}) GROUP BY 1""",
    ),
    "latest_state": _with(*_ORDER_LOG, "state", body=f"SELECT {_STATE_COLUMNS} FROM state"),
    "latest_state_lenient": _with(
        *_ORDER_LOG, "damaged_log", "lenient_state", body=f"SELECT {_STATE_COLUMNS} FROM lenient_state"
    ),
    "wire_types": """SELECT o_orderkey AS id, CAST(o_orderkey % 1000 AS INTEGER) AS small,
  CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
  CAST(CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 0 END AS INTEGER) AS flag,
  CAST(o_orderdate AS DATE) AS day, epoch_ms(o_orderdate) AS instant, o_orderpriority AS note FROM orders""",
    "change_diff": _with(
        *_FULL_LOG,
        body=f"""SELECT "offset", "partition", "table", {_OP_LABEL.replace("CASE op", f"CASE {_OP}")} AS operation,
  coalesce({_after("id")}, json_extract_string(value, '$.payload.before.id')) AS row_key,
  {_changes_text()} AS changes FROM full_log WHERE value IS NOT NULL""",
    ),
    "change_summary": _with(
        *_FULL_LOG,
        body=f"""{_CHANGE_COUNTS}
UNION ALL SELECT 'TOTAL', NULL, count(*) FROM full_log WHERE value IS NOT NULL""",
    ),
    "raw_profile": _with(
        *_FULL_LOG,
        body="""SELECT 'table' AS scope, "table", NULL::DATE AS ingest_date, count(*) AS n_rows,
  count(*) - count(value) AS n_tombstones FROM full_log GROUP BY "table"
UNION ALL SELECT 'ingest_date', NULL, ingest_date, count(*), count(*) - count(value) FROM full_log GROUP BY ingest_date
UNION ALL SELECT 'total', NULL, NULL, count(*), count(*) - count(value) FROM full_log""",
    ),
    "state_profile": _with(
        *_ORDER_LOG, "state",
        body="""SELECT 'orders_ledger' AS "table", last_op, count(*) AS n_rows, count(deleted_at) AS n_soft_deleted
FROM state GROUP BY last_op
UNION ALL SELECT 'orders_ledger', 'ALL', count(*), count(deleted_at) FROM state""",
    ),
    "state_sample": _with(
        *_ORDER_LOG, "state",
        body="""SELECT last_op, id, owner_id, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY last_op ORDER BY md5(CAST(id AS VARCHAR)), id) AS place FROM state) WHERE place <= 3""",
    ),
    "state_rebuild": _with(
        *_ORDER_LOG, "owner_log", "damaged_log", "lenient_state",
        body="""SELECT 'orders_ledger' AS layer, count(*) AS n_written, count(*) AS n_stored FROM lenient_state
UNION ALL SELECT 'owners', count(*), count(*) FROM customer
UNION ALL SELECT 'quarantined orders_ledger', count(*), count(*) FROM damaged_log
  WHERE value IS NOT NULL AND "offset" % 16 IN (5, 6, 7, 8)
UNION ALL SELECT 'quarantined owners', 0, 0""",
    ),
    "layer_writes": _with(
        *_BALANCE,
        body="""SELECT layer, count(*) AS n_written, count(*) AS n_stored, CASE WHEN layer = 'single file' THEN 1::BIGINT END AS n_files,
  CAST(sum(balance) AS DECIMAL(18,2)) AS total
FROM balance, (VALUES ('overwritten'), ('single file'), ('clustered')) v(layer) GROUP BY layer""",
    ),
    "offset_backlog": _with(
        *_FULL_LOG,
        body="""SELECT a.topic, a."partition", a.next_offset - coalesce(c.next_offset, 0) AS n_pending
FROM (SELECT topic, "partition", max("offset") + 1 AS next_offset FROM full_log GROUP BY ALL) a
LEFT JOIN (SELECT topic, "partition", max("offset") + 1 AS next_offset FROM full_log
           WHERE ingest_date < DATE '2000-01-01' AND "table" <> 'owners' GROUP BY ALL) c
  ON a.topic = c.topic AND a."partition" = c."partition"
WHERE a.next_offset > coalesce(c.next_offset, 0)""",
    ),
    "latency_pairs": _with(*_PAIRS, body="SELECT * FROM pairs"),
    "latency_unmatched": _with(*_PAIRS, body="SELECT row_id, ordinal, op FROM pairs WHERE has_event = 0"),
    "latency_summary": _with(
        *_PAIRS,
        body=_union(
            _percentiles("sent_to_emit_ms", "sent_to_emit"),
            _percentiles("answer_to_emit_ms", "answer_to_emit"),
            _percentiles("source_to_emit_ms", "source_to_emit"),
            _percentiles("sent_to_emit_ms - 40", "sent_to_emit_corrected"),
            _percentiles("answer_to_emit_ms - 40", "answer_to_emit_corrected"),
        ),
    ),
    # ----------------------------------------------------------------------------- rollups
    "period_bucket": "SELECT o_orderkey AS entry_id, CAST(o_orderdate AS DATE) AS day, "
    + ", ".join(f"CAST(date_trunc('{u}', o_orderdate) AS DATE) AS {u}" for u in ("week", "month", "quarter", "year"))
    + " FROM orders",
    "active_rows": _with("entries", body="SELECT entry_id, owner_id, amount FROM entries WHERE deleted_at IS NULL"),
    "period_totals": _with(
        *_LEDGER_BASE,
        body="""SELECT owner_id, period, CAST(sum(amount) AS DECIMAL(18,2)) AS total, count(*) AS n
FROM active WHERE is_inflow GROUP BY owner_id, period""",
    ),
    "period_balance": _with(
        *_BALANCE, body="SELECT owner_id, period, total_in, total_out, balance, n_in, n_out FROM balance"
    ),
    "running_balance": _with(*_BALANCE, body="SELECT * FROM balance"),
    "closing_balance": _with(
        *_BALANCE,
        body="""SELECT owner_id, max(period) AS period, arg_max(running_balance, period) AS closing_balance
FROM balance GROUP BY owner_id""",
    ),
    "category_spend": _with(*_SPEND, body="SELECT * FROM category_spend"),
    "method_spend": _with(*_LEDGER_BASE, "method_spend", body="SELECT * FROM method_spend"),
    "period_change": _with("supplier_spend", body="SELECT * FROM supplier_spend"),
    "span_profile": _with(
        *_LEDGER_BASE,
        body="""SELECT CASE WHEN is_inflow THEN 'in' ELSE 'out' END AS direction, count(*) AS n_active,
  count(ended_at) AS n_with_end, count(recurrence_id) AS n_recurring,
  count(*) FILTER (WHERE date_trunc('month', ended_at) <> date_trunc('month', started_at)) AS n_multi_month,
  count(*) - count(category_id) AS n_without_dimension FROM active GROUP BY 1""",
    ),
    # ---------------------------------------------------------------------------- outliers
    "iqr_stats": _with(
        "movements", "stats",
        body=f"SELECT user_id, category_id, n_group, {_MONEY_FENCES} FROM stats WHERE n_group >= 8 AND iqr > 0",
    ),
    "iqr_stats_sketched": _with(
        "movements", "stats", body="SELECT user_id, category_id, n_group, true AS q1_fits, true AS q3_fits FROM stats"
    ),
    "iqr_outliers": _with(*_FOUND, body="SELECT * FROM found"),
    "outlier_summary": _with(
        *_FOUND,
        body=_union(
            "SELECT 'n_rows' AS measure, CAST(sum(n_group) AS BIGINT) AS n FROM stats",
            "SELECT 'n_groups', count(*) FROM stats",
            "SELECT 'n_judged', count(*) FROM stats WHERE n_group >= 8 AND iqr > 0",
            "SELECT 'n_too_small', count(*) FROM stats WHERE n_group < 8",
            "SELECT 'n_flat', count(*) FROM stats WHERE n_group >= 8 AND iqr = 0",
            "SELECT 'n_mild', count(*) FROM found WHERE severity = 'mild'",
            "SELECT 'n_extreme', count(*) FROM found WHERE severity = 'extreme'",
            "SELECT 'n_outliers', count(*) FROM found",
        ),
    ),
    "outlier_hotspots": _with(
        *_FOUND, body="SELECT user_id, label, count(*) AS n_outliers FROM found GROUP BY user_id, label"
    ),
    "outlier_report": _with(
        *_FOUND,
        body="""SELECT event_id, user_id, label, occurred_on, amount, mild_fence, extreme_fence, excess, severity,
  CASE severity WHEN 'extreme' THEN '#C62828' WHEN 'mild' THEN '#F9A825' ELSE '#000000' END AS colour FROM found""",
    ),
    "top_outliers": _with(
        *_FOUND,
        body="""SELECT event_id, user_id, label, amount, mild_fence, excess, severity FROM found
ORDER BY excess DESC, event_id LIMIT 10""",
    ),
    # ----------------------------------------------------------------------------- reports
    "dim_entity": _with(*_LEDGER_BASE, body="SELECT DISTINCT owner_id FROM active"),
    "dim_period": _with(
        *_LEDGER_BASE, body="SELECT DISTINCT period, strftime(period, '%Y-%m') AS label FROM active"
    ),
    "star_filter": _with(
        *_SPEND, "chosen_owners",
        body="""SELECT * FROM category_spend
WHERE owner_id IN (SELECT c_custkey FROM chosen_owners) AND period >= DATE '1997-01-01'""",
    ),
    "kpi_totals": _with(
        *_BALANCE, "chosen_owners",
        body="""SELECT owner_id, CAST(sum(total_in) AS DECIMAL(18,2)) AS inflows,
  CAST(sum(total_out) AS DECIMAL(18,2)) AS outflows, CAST(sum(total_in) - sum(total_out) AS DECIMAL(18,2)) AS net
FROM balance WHERE owner_id IN (SELECT c_custkey FROM chosen_owners) AND period >= DATE '1997-01-01'
GROUP BY owner_id""",
    ),
    "kpi_cards": _with(
        *_BALANCE,
        body="SELECT owner_id, "
        + ", ".join(
            f"CASE WHEN {v} < 0 THEN '-$' ELSE '$' END || format('{{:,}}', CAST(trunc(abs({v})) AS BIGINT)) || '.' || "
            f"lpad(CAST(CAST(abs({v}) * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0') AS {n}"
            for v, n in (("i", "inflows"), ("o", "outflows"), ("(i - o)", "net"))
        )
        + " FROM (SELECT owner_id, sum(total_in) AS i, sum(total_out) AS o FROM balance GROUP BY owner_id)",
    ),
    "portfolio_running": _with(
        *_BALANCE, "chosen_owners",
        body="""SELECT period, CAST(net AS DECIMAL(18,2)) AS net,
  CAST(sum(net) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS running_net
FROM (SELECT period, sum(balance) AS net FROM balance
      WHERE owner_id IN (SELECT c_custkey FROM chosen_owners) GROUP BY period)""",
    ),
    "category_by_period": _with(
        *_SPEND,
        body="""SELECT period, label, CAST(sum(total) AS DECIMAL(18,2)) AS total
FROM category_spend GROUP BY period, label""",
    ),
    "method_by_period": _with(
        *_LEDGER_BASE, "method_spend",
        body="SELECT period, "
        + ", ".join(
            f"CAST(coalesce(sum(total) FILTER (WHERE {which}), 0) AS DECIMAL(18,2)) AS {c}"
            for which, c in [
                *((f"label = 'NATION_{i}'", f"method_{i}") for i in range(5)),
                ("label = 'No method'", "no_method"),
                ("label NOT IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'No method')", "other_methods"),
            ]
        )
        + " FROM method_spend GROUP BY period",
    ),
    "change_with_total": _with(
        "supplier_spend",
        body=f"""SELECT period, flag, current_total, prior_total, {_percent("num", "den")} AS change_pct
FROM (SELECT *, CAST((current_total - prior_total) * 100 AS HUGEINT) * 10000 AS num,
             CAST(prior_total * 100 AS HUGEINT) AS den
      FROM (SELECT period, CASE WHEN grouping(flag) = 1 THEN 'TOTAL' ELSE flag END AS flag,
                   CAST(sum(total) AS DECIMAL(18,2)) AS current_total,
                   CAST(sum(prior_total) AS DECIMAL(18,2)) AS prior_total
            FROM supplier_spend GROUP BY GROUPING SETS ((period, flag), (period))))""",
    ),
    "change_ranked": _with(
        "supplier_spend",
        body="""SELECT *, CASE WHEN change_pct > 0 THEN 'red' WHEN change_pct < 0 THEN 'green' END AS colour
FROM supplier_spend""",
    ),
    "entity_period_report": _with(
        "supplier_spend",
        body="SELECT flag, total FROM supplier_spend WHERE supplier_id = 5 AND period = DATE '2000-04-01'",
    ),
    "latest_periods": _with(
        *_BALANCE,
        body="""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY period DESC) AS rn FROM balance) WHERE rn <= 3""",
    ),
    # ------------------------------------------------------------------------------ checks
    "check_nulls": _with(
        *_BALANCE,
        body=_problem("nulls", "balance", "'total_in'", "n || ' null values'",
                      "(SELECT count(*) AS n FROM balance WHERE owner_id % 29 = 0) WHERE n > 0"),
    ),
    "check_unique": _CHECK_UNIQUE,
    "unique_counts": """SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem""",
    "check_period_start": _with(
        *_BALANCE,
        body=_problem("period start", "balance", "owner_id", "'period is ' || CAST(period + 14 AS VARCHAR)",
                      "balance WHERE owner_id % 23 = 0"),
    ),
    "check_nonnegative": _with(
        *_BALANCE,
        body=_union(
            _problem("negative", "balance", "owner_id || '|' || period", "'total_out is ' || CAST(-total_out AS VARCHAR)",
                     "balance WHERE owner_id % 41 = 0 AND total_out > 0"),
            _problem("negative", "balance", "owner_id || '|' || period", "'n_in is -1'",
                     "balance WHERE owner_id % 43 = 0"),
        ),
    ),
    "check_balance": _with(
        *_BALANCE,
        body=", " + _PLANTED_BALANCE + _union(
            _problem("balance", "balance", "owner_id || '|' || period",
                     "'balance ' || CAST(balance AS DECIMAL(18,2)) || ', in minus out ' || net",
                     "checked WHERE balance <> net"),
            _problem("balance", "balance", "owner_id || '|' || period",
                     "'running balance ' || CAST(running_balance AS DECIMAL(18,2)) || ', sum so far ' || so_far",
                     "checked WHERE running_balance <> so_far"),
        ),
    ),
    "check_breakdown": _with(
        *_LEDGER_BASE, "balance", "category_spend",
        body=""", b AS (
  SELECT owner_id, period, sum(total + CASE WHEN category_id = 3 AND owner_id % 13 = 0 THEN 1 ELSE 0 END) AS total,
         sum(n) AS n FROM category_spend WHERE NOT (category_id = -1 AND owner_id % 37 = 0) GROUP BY owner_id, period),
j AS (
  SELECT balance.owner_id, balance.period, CAST(coalesce(b.total, 0) AS DECIMAL(18,2)) AS lt,
         CAST(coalesce(b.n, 0) AS BIGINT) AS ln, total_out AS rt, n_out AS rn
  FROM balance LEFT JOIN b ON b.owner_id = balance.owner_id AND b.period = balance.period)
"""
        + _problem("breakdown", "category_spend", "owner_id || '|' || period",
                   "'breakdown ' || lt || ' / ' || ln || ', balance ' || rt || ' / ' || rn",
                   "j WHERE lt <> rt OR ln <> rn"),
    ),
    "check_change": _with(
        "supplier_spend",
        body=""", planted AS (
  SELECT *, CAST(CASE WHEN supplier_id % 9 = 0 THEN prior_total + 1 ELSE prior_total END AS DECIMAL(18,2)) AS got_prior,
         CASE WHEN supplier_id % 11 = 0 THEN CAST(999.99 AS DECIMAL(26,2)) ELSE change_pct END AS got_change
  FROM supplier_spend)
"""
        + _problem("change", "supplier_spend", "supplier_id || '|' || flag || '|' || period",
                   f"'prior ' || {_text('got_prior')} || ' expected ' || {_text('prior_total')} || ', change ' || "
                   f"{_text('got_change')} || ' expected ' || {_text('change_pct')}",
                   "planted WHERE got_prior IS DISTINCT FROM prior_total OR got_change IS DISTINCT FROM change_pct"),
    ),
    "check_recompute": _with(
        *_SPEND,
        body=_union(
            *[
                _problem("recomputation", "category_spend", "owner_id || '|' || period || '|' || category_id",
                         f"'{side} row x1'", "category_spend WHERE category_id = 2 AND owner_id % 13 = 0")
                for side in ("unexpected", "missing")
            ]
        ),
    ),
    "check_outlier_rules": _with(
        *_FOUND,
        body=", " + _PLANTED_OUTLIERS + _union(
            *[
                _problem("outlier rule", "outliers", "event_id", f"'{rule}'", f"doubled WHERE {broken}")
                for rule, broken in _OUTLIER_RULES.items()
            ],
            _problem("unique", "outliers", "event_id", "'2 rows'", "planted WHERE event_id % 4 = 0"),
        ),
    ),
    "check_outlier_orphans": _with(
        *_FOUND,
        body=_union(
            _problem("outlier source", "outliers", "-event_id - 1", "'is not an active row'",
                     "found WHERE event_id % 11 = 0"),
            _problem("outlier source", "outliers", "event_id", "'user_id or amount differs from the active row'",
                     "found WHERE event_id % 11 <> 0 AND event_id % 7 = 0"),
        ),
    ),
    "check_outlier_recompute": _with(
        *_FOUND,
        body=_union(
            _problem("outlier recomputation", "outliers", "event_id", "'severity NULL, recomputed ' || severity",
                     "found WHERE event_id % 5 = 0"),
            _problem("outlier recomputation", "outliers", "event_id", "'severity extreme, recomputed mild'",
                     "found WHERE event_id % 5 <> 0 AND event_id % 7 = 0 AND severity = 'mild'"),
        ),
    ),
    "check_state": _with(
        *_ORDER_LOG, "state",
        body=""", planted AS (SELECT id, last_op FROM state UNION ALL SELECT id, last_op FROM state WHERE id % 307 = 0)
"""
        + _union(
            _problem("state", "orders_ledger", "'key'", "n || ' repeated rows'",
                     "(SELECT count(*) - count(DISTINCT id) AS n FROM planted) WHERE n > 0"),
            _problem("state", "orders_ledger", "'_last_op'", "n || ' rows end in a delete'",
                     "(SELECT count(*) AS n FROM planted WHERE id % 501 = 0) WHERE n > 0"),
            _problem("state", "orders_ledger", "'amount'", "n || ' null values'",
                     "(SELECT count(*) AS n FROM planted WHERE id % 403 = 0) WHERE n > 0"),
            _problem("state", "empty_ledger", "'rows'", "'table is empty'", "(SELECT 1)"),
        ),
    ),
    "check_totals": _with(
        *_BALANCE,
        body=_problem(
            "totals", "balance", "'outflows'",
            "'left ' || CAST(wrong AS DECIMAL(38,2)) || ', right ' || CAST(good AS DECIMAL(38,2))",
            "(SELECT sum(total_out + CASE WHEN owner_id % 13 = 0 THEN 1 ELSE 0 END) AS wrong, sum(total_out) AS good "
            "FROM balance)",
        ),
    ),
    "check_ranges": _with(
        "entries",
        body=_union(
            *[
                _problem("range", "entries", "entry_id", f"'{rule}'", f"entries WHERE {broken}")
                for rule, broken in _RANGE_RULES.items()
            ]
        ),
    ),
    "check_orphans": _with("entries", body=_CHECK_ORPHANS),
    "check_contract": _with(
        *_BALANCE,
        body="""SELECT 'contract' AS "check", 'balance' AS "table", k AS "key", d AS detail FROM (VALUES
  ('n_out', 'column is missing'), ('name', 'column is not in the contract'),
  ('total_in', 'type is double, the contract says decimal(18,2)')) v(k, d)
UNION ALL SELECT 'forbidden column', 'balance', 'name', 'must not be stored'
UNION ALL SELECT 'unique', 'balance', CAST(owner_id AS VARCHAR), count(*) || ' rows' FROM balance GROUP BY owner_id HAVING count(*) > 1""",
    ),
    "check_gate": _with(
        "entries",
        body=f""", found AS ({_CHECK_ORPHANS} UNION ALL {_CHECK_UNIQUE}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "check", "table" ORDER BY "key", detail) AS rn,
                  count(*) OVER (PARTITION BY "check", "table") AS n FROM found)
SELECT "check" || ' on ' || "table" || ': ' || n || ' (' || string_agg("key" || ': ' || detail, '; ' ORDER BY rn)
    || CASE WHEN n > 5 THEN '; ... and ' || (n - 5) || ' more' ELSE '' END || ')' AS line
FROM ranked WHERE rn <= 5 GROUP BY "check", "table", n""",
    ),
    "check_report": _with(
        "entries",
        body=f""", found AS ({_CHECK_ORPHANS} UNION ALL {_CHECK_UNIQUE}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "check", "table" ORDER BY "key", detail) AS rn,
                  count(*) OVER (PARTITION BY "check", "table") AS n FROM found)
SELECT "check", "table", n AS n_problems,
  string_agg("key" || ': ' || detail, '; ' ORDER BY rn)
    || CASE WHEN n > 5 THEN '; ... and ' || (n - 5) || ' more' ELSE '' END AS examples
FROM ranked WHERE rn <= 5 GROUP BY "check", "table", n""",
    ),
    # ---------------------------------------------------------------------- reconciliation
    "recon_counts": _with(
        *_ORDER_LOG, "state",
        body=_problem("row count", "orders_ledger", "'rows'", "'lake ' || lake || ', source ' || source",
                      "(SELECT (SELECT count(*) FROM state) AS lake, (SELECT count(*) FROM orders) AS source)"),
    ),
    "recon_totals": _with(
        *_BALANCE,
        body=""", s AS (
  SELECT owner_id, period, sum(amount + CASE WHEN entry_id % 1000 = 0 THEN 1 ELSE 0 END) AS total, count(*) AS n
  FROM active WHERE is_inflow GROUP BY owner_id, period)
"""
        + _problem("source totals", "balance", "s.owner_id || '|' || s.period",
                   "'lake ' || total_in || ' / ' || n_in || ', source ' || CAST(total AS DECIMAL(18,2)) || ' / ' || n",
                   "s JOIN balance b ON s.owner_id = b.owner_id AND s.period = b.period "
                   "WHERE total <> total_in OR n <> n_in"),
    ),
    "multiset_diff": _with(
        *_ORDER_LOG, "state",
        body="""SELECT id, owner_id, amount, 'left' AS side, count(*) AS n_extra
FROM (SELECT id, owner_id, amount FROM order_rows EXCEPT ALL SELECT id, owner_id, amount FROM state) GROUP BY ALL
UNION ALL SELECT id, owner_id, amount, 'right', count(*)
FROM (SELECT id, owner_id, amount FROM state EXCEPT ALL SELECT id, owner_id, amount FROM order_rows) GROUP BY ALL""",
    ),
    "warehouse_check": _with(
        *_BALANCE,
        body="""SELECT 'warehouse rows' AS "check", 'balance' AS "table", owner_id || '|' || period AS "key", detail
FROM balance, (VALUES ('only published x1'), ('only in the warehouse x1')) v(detail) WHERE owner_id % 31 = 0""",
    ),
    "publish_plan": _with(
        *_LEDGER_BASE, "balance", "category_spend",
        body="""SELECT 'balance' AS "table", 'target/balance' AS target, count(*) AS n_rows, true AS has_files, true AS has_bytes FROM balance
UNION ALL SELECT 'category_spend', 'target/category_spend', count(*), true, true FROM category_spend""",
    ),
    "publish_retention": _with(
        *_BALANCE,
        body="""SELECT count(*) AS n_rows, CAST(sum(balance) AS DECIMAL(18,2)) AS total, true AS first_is_gone, true AS files_are_whole
FROM balance""",
    ),
    "publish_manifest": _with(
        *_LEDGER_BASE, "balance", "category_spend",
        body=f"""SELECT 'balance' AS "table", count(*) AS n_rows, {_digest(_BALANCE_COLUMNS)} AS digest FROM balance
UNION ALL SELECT 'category_spend', count(*), {_digest(_SPEND_COLUMNS)} FROM category_spend""",
    ),
}
