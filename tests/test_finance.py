"""The finance lake: results, defects that every check has to find, and the daily run."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import quality, reconcile
from ledgerlake.plans import finance
from ledgerlake.sinks import publish
from ledgerlake.sources import events
from ledgerlake.sources.relational import FrameSource
from tests import finance_lake as lakes
from tests.conftest import rows


@pytest.fixture(scope="module")
def lake():
    return lakes.build()


@pytest.fixture(scope="module")
def state(spark, lake):
    return lakes.frames(spark, lake)


@pytest.fixture(scope="module")
def tables(spark, state):
    """Curated tables, materialised once."""
    return {n: spark.createDataFrame(f.collect(), finance.CURATED[n].schema) for n, f in finance.curated(state).items()}


def ordered(lines):
    return sorted(lines, key=repr)


def test_curated_tables_match_plain_arithmetic(spark, lake):
    wide = lakes.unknown_ids(lake)
    found = finance.curated(lakes.frames(spark, wide))
    assert rows(found["balance_mensual"]) == ordered(lakes.balance(wide))
    by_category = lakes.spend(wide, "destino_id", "destinos", "Sin destino")
    assert rows(found["gasto_por_destino_mensual"]) == ordered(by_category)
    by_method = lakes.spend(wide, "tipo_id", "tipos_egreso", "Sin tipo")
    assert rows(found["gasto_por_tipo_mensual"]) == ordered(by_method)
    assert rows(found["anomalias"], "egreso_id", "severidad") == ordered(lakes.high_amounts(wide))
    for name, frame in found.items():
        assert [(f.name, f.dataType) for f in frame.schema] == [
            (f.name, f.dataType) for f in finance.CURATED[name].schema
        ]


def test_the_lake_has_the_hard_cases(lake, tables):
    spend = tables["gasto_por_destino_mensual"]
    assert not spend.filter("destino = 'Sin destino'").isEmpty()
    assert not spend.filter("destino = 'Health'").isEmpty()
    assert not spend.filter("variacion_pct < 0").isEmpty()
    assert not tables["balance_mensual"].filter("n_ingresos = 0").isEmpty()
    assert {r[0] for r in rows(tables["anomalias"], "severidad")} == {"atipico", "extremo"}
    assert any(r["eliminado_en"] for r in lake["egresos"])


def test_a_sound_lake_has_no_problems(spark, tables, state):
    quality.gate(finance.state_problems(state))
    quality.gate(finance.contract_problems(spark, tables))
    quality.gate(finance.coherence_problems(tables, state))
    quality.gate(finance.outlier_problems(tables["anomalias"], state))
    quality.gate(finance.source_problems(tables, state, FrameSource(state)))


# ----------------------------------------------------------------------------- planted defects
BALANCE, CATEGORY, METHOD, OUTLIERS = list(finance.CURATED)
TOTALS = ("total_ingresos", "total_egresos", "balance", "balance_acumulado")


def first(frame, where="true"):
    """Condition that holds for one row of a table."""
    row = frame.filter(where).orderBy(*finance.CURATED[name_of(frame)].keys).first()
    keys = finance.CURATED[name_of(frame)].keys
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.lit(row[key]))
    return condition


def name_of(frame):
    return next(n for n, s in finance.CURATED.items() if s.columns == frame.columns)


def change(frame, where="true", **values):
    """The table with other values in one row."""
    chosen = first(frame, where)
    columns = [
        F.when(chosen, (v(F.col(c)) if callable(v) else F.lit(v)).cast(frame.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if (v := values.get(c, ...)) is not ...
        else F.col(c)
        for c in frame.columns
    ]
    return frame.select(*columns)


def without(frame, where="true"):
    return frame.filter(~first(frame, where))


def doubled(frame):
    return frame.unionByName(frame.filter(first(frame)))


def plus_one(column):
    return column + 1


def contract(table, schema_change):
    return lambda s, t, st: quality.contract_problems(s, schema_change(t[table]).schema, finance.CURATED[table])


def required(table, **values):
    return lambda s, t, st: quality.null_problems(change(t[table], **values), table, finance.CURATED[table].required)


def unique(table):
    return lambda s, t, st: quality.duplicate_problems(doubled(t[table]), table, finance.CURATED[table].keys)


def balanced(**values):
    return lambda s, t, st: quality.balance_problems(change(t[BALANCE], **values), BALANCE, "usuario_id", "mes", TOTALS)


def breakdown(table, alter):
    return lambda s, t, st: quality.compare_totals(
        alter(t[table]), t[BALANCE], ["usuario_id", "mes"], ["total_egresos", "n_egresos"], "breakdown", table
    )


def changed(table, dim, where, **values):
    return lambda s, t, st: quality.change_problems(
        change(t[table], where, **values), table, ["usuario_id", dim], "mes", "total_egresos",
        "total_mes_anterior", "variacion_pct",
    )


NEUTRAL = {v: k for k, v in finance._OUTLIER_NAMES.items()}


def judged(where="true", **values):
    def find(s, t, st):
        bad = change(t[OUTLIERS], where, **values).withColumnsRenamed(NEUTRAL)
        return quality.outlier_rule_problems(bad, OUTLIERS, "id", "monto", finance.FENCES)

    return find


def recomputed(table, alter):
    def find(s, t, st):
        other = {**st, table: alter(st[table])}
        if table == "ingresos":
            return finance.recompute_balance_problems(t[BALANCE], other)
        spec = (CATEGORY, "destino_id", "destino", "destinos", finance.NO_CATEGORY)
        return finance.recompute_spend_problems(t[CATEGORY], other, *spec)

    return find


def state_of(table, alter):
    return lambda s, t, st: finance.state_problems({**st, table: alter(st[table])})


def from_source(alter):
    return lambda s, t, st: finance.outlier_problems(alter(t[OUTLIERS]), st)


def warehouse(table, **types):
    def find(s, t, st):
        reported = {f.name: reconcile.warehouse_type(f.dataType) for f in finance.CURATED[table].schema}
        reported |= {c: v for c, v in types.items() if v}
        return reconcile.warehouse_schema_problems(
            s, {c: v for c, v in reported.items() if types.get(c, "") is not None}, finance.CURATED[table]
        )

    return find


def stored(table, alter):
    def find(s, t, st):
        return reconcile.recompute_problems(alter(t[table]), t[table], table, finance.CURATED[table])

    return find


def source(alter):
    return lambda s, t, st: finance.source_problems(t, st, FrameSource(alter(st)))


ACTIVE = "eliminado_en IS NULL"


def one_of(rows_, where):
    return F.col("id") == rows_.filter(where).agg(F.min("id")).first()[0]


def copy_of(rows_, where, **values):
    copy = rows_.filter(one_of(rows_, where))
    for column, value in values.items():
        copy = copy.withColumn(column, F.lit(value).cast(rows_.schema[column].dataType))
    return rows_.unionByName(copy)


DEFECTS = {
    "renamed column": contract(BALANCE, lambda f: f.withColumnRenamed("balance", "neto")),
    "decimal became double": contract(BALANCE, lambda f: f.withColumn("total_ingresos", F.col("total_ingresos").cast("double"))),
    "extra column": contract(OUTLIERS, lambda f: f.withColumn("descripcion", F.lit("x"))),
    "missing column": contract(METHOD, lambda f: f.drop("tipo")),
    "free text in the output": lambda s, t, st: quality.forbidden_columns(
        s, t[OUTLIERS].withColumn("descripcion", F.lit("x")).schema, OUTLIERS, finance.FREE_TEXT
    ),
    "null owner": required(BALANCE, usuario_id=None),
    "null category": required(CATEGORY, destino=None),
    "null total": required(METHOD, total_egresos=None),
    "repeated balance row": unique(BALANCE),
    "repeated outlier": unique(OUTLIERS),
    "month does not start on day 1": lambda s, t, st: quality.period_start_problems(
        change(t[BALANCE], mes=dt.date(2026, 1, 15)), BALANCE, ["usuario_id"], "mes"
    ),
    "negative count": lambda s, t, st: quality.negative_problems(
        change(t[BALANCE], n_egresos=-1), BALANCE, ["usuario_id", "mes"], ["n_egresos"]
    ),
    "negative total": lambda s, t, st: quality.negative_problems(
        change(t[CATEGORY], total_egresos=-5), CATEGORY, ["usuario_id", "mes"], ["total_egresos"]
    ),
    "wrong balance": balanced(balance=plus_one),
    "wrong running balance": balanced(balance_acumulado=plus_one),
    "breakdown has another total": breakdown(CATEGORY, lambda f: change(f, total_egresos=plus_one)),
    "breakdown has another count": breakdown(CATEGORY, lambda f: change(f, n_egresos=plus_one)),
    "breakdown lacks a row": breakdown(METHOD, without),
    "wrong change": changed(CATEGORY, "destino_id", "variacion_pct IS NOT NULL", variacion_pct="999.99"),
    "wrong prior total": changed(METHOD, "tipo_id", "total_mes_anterior IS NOT NULL", total_mes_anterior=1),
    "prior total where there is none": changed(METHOD, "tipo_id", "total_mes_anterior IS NULL", total_mes_anterior=1),
    "invented severity": judged(severidad="grave"),
    "amount below the mild fence": judged(monto=0),
    "extreme below the extreme fence": judged("severidad = 'atipico'", severidad="extremo"),
    "mild above the extreme fence": judged("severidad = 'extremo'", severidad="atipico"),
    "outlier of a small group": judged(n_grupo=3),
    "outlier of a flat group": judged(iqr=0),
    "fences out of order": judged(limite_extremo=0),
    "wrong excess": judged(exceso_sobre_limite=plus_one),
    "curated counts a vanished row": recomputed("egresos", lambda f: f.filter(~one_of(f, ACTIVE))),
    "curated lacks a new inflow": recomputed(
        "ingresos", lambda f: copy_of(f, ACTIVE, id=99999, monto="123.45")
    ),
    "curated counts a soft-deleted row": recomputed(
        "egresos",
        lambda f: f.withColumn("eliminado_en", F.when(one_of(f, ACTIVE), F.lit(lakes.T0)).otherwise(F.col("eliminado_en"))),
    ),
    "category was renamed": recomputed("destinos", lambda f: f.withColumn("nombre", F.upper("nombre"))),
    "outlier that does not exist": from_source(lambda f: f.unionByName(f.limit(1).withColumn("egreso_id", F.lit(999999).cast("bigint")))),
    "outlier of another owner": from_source(lambda f: change(f, usuario_id=9)),
    "outlier is missing": from_source(without),
    "outlier with another severity": from_source(lambda f: change(f, "severidad = 'atipico'", severidad="extremo")),
    "warehouse: decimal became float": warehouse(BALANCE, total_ingresos="FLOAT64"),
    "warehouse: column is missing": warehouse(OUTLIERS, severidad=None),
    "warehouse: extra column": warehouse(OUTLIERS, otra="STRING"),
    "stored table lacks a row": stored(CATEGORY, without),
    "stored table has another amount": stored(BALANCE, lambda f: change(f, total_egresos=plus_one)),
    "stored table repeats a row": stored(OUTLIERS, doubled),
    "source has one row more": source(lambda st: {**st, "metas": copy_of(st["metas"], "true", id=77)}),
    "source has another total": source(
        lambda st: {**st, "egresos": st["egresos"].withColumn(
            "monto", F.when(one_of(st["egresos"], ACTIVE), F.col("monto") + 1).otherwise(F.col("monto")).cast("decimal(12,2)")
        )}
    ),
    "source has a month the lake lacks": source(
        lambda st: {**st, "ingresos": copy_of(
            st["ingresos"].filter(~one_of(st["ingresos"], ACTIVE)), ACTIVE, id=88, fecha_inicio=dt.datetime(2030, 1, 1)
        )}
    ),
    "state table is empty": state_of("frecuencias", lambda f: f.limit(0)),
    "state repeats an id": state_of("metas", lambda f: f.unionByName(f.limit(1))),
    "state keeps a delete": state_of("metas", lambda f: f.withColumn("_ultima_op", F.lit("d"))),
    "state has a null amount": state_of("ingresos", lambda f: f.withColumn("monto", F.lit(None).cast("decimal(12,2)"))),
    "state breaks a value rule": state_of(
        "inversiones", lambda f: f.withColumn("tasa_interes", F.lit("100.01").cast("decimal(5,2)"))
    ),
    "state has an orphan": state_of("egresos", lambda f: copy_of(f, ACTIVE, id=88, destino_id=77)),
    "state repeats a name": state_of("usuarios", lambda f: f.withColumn("correo", F.lit("same@example.org"))),
}


@pytest.mark.parametrize("defect", list(DEFECTS))
def test_a_check_finds_the_defect(spark, tables, state, defect):
    found = DEFECTS[defect](spark, tables, state)
    assert found.columns == ["check", "table", "key", "detail"]
    assert not found.isEmpty()


def test_gate_names_the_check_and_the_table(spark):
    found = spark.createDataFrame([("c", "t", "k", "bad")], quality.PROBLEM)
    with pytest.raises(quality.QualityError, match=r"c on t: 1 \(k: bad\)"):
        quality.gate(found)
    quality.gate(found.limit(0))


def test_report_caps_examples_and_counts_the_rest(spark):
    lines = [("c", "t", f"k{i}", "bad") for i in range(8)] + [("c", "u", "k", "bad")]
    found = quality.report(spark.createDataFrame(lines, quality.PROBLEM))
    assert rows(found) == [
        ("c", "t", 8, "k0: bad; k1: bad; k2: bad; k3: bad; k4: bad; ... and 3 more"),
        ("c", "u", 1, "k: bad"),
    ]


# --------------------------------------------------------------------------------- daily run
def _wire(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, dt.datetime):
        return int(value.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    if isinstance(value, dt.date):
        return (value - dt.date(1970, 1, 1)).days
    return value


def send(spark, path, lake, offset=0, op="r"):
    """Write messages of all rows as a file that the stream picks up."""
    lines = []
    for table, rows_ in lake.items():
        for i, row in enumerate(rows_):
            payload = {"op": op, "before": None, "after": {c: _wire(v) for c, v in row.items()}}
            value = json.dumps({"payload": payload}).encode()
            lines.append((f"lake.{table}", 0, offset + i, lakes.T0, b"k", value))
    lines.append(("lake.auth_tokens", 0, offset, lakes.T0, b"k", b"secret"))
    spark.createDataFrame(lines, events.MESSAGE).coalesce(1).write.mode("append").parquet(path)


def test_daily_run_end_to_end(spark, folder, lake):
    paths = finance.Lake(*(f"{folder}/{n}" for n in ("raw", "checkpoint", "state", "curated", "published")))
    send(spark, f"{folder}/topics", lake)
    stream = lambda: events.file_events(spark, f"{folder}/topics")
    first_run = finance.daily_run(spark, paths, stream(), "lake.")
    nothing_aside = {f"quarantined {name}": 0 for name in finance.SOURCE}
    assert first_run["state"] == {name: len(rows_) for name, rows_ in lake.items()} | nothing_aside
    published = publish.read_published(spark, paths.published, "balance_mensual")
    assert rows(published) == ordered(lakes.balance(lake))
    assert "auth_tokens" not in {r[0] for r in rows(spark.read.parquet(paths.raw), "tabla")}

    # One inflow grows: only its message is new, and every layer follows.
    grown = [dict(lake["ingresos"][0], monto=Decimal("4321.00"))]
    later = {**lake, "ingresos": grown + lake["ingresos"][1:]}
    send(spark, f"{folder}/topics", {"ingresos": grown}, offset=10_000, op="u")
    second_run = finance.daily_run(spark, paths, stream(), "lake.")
    assert second_run["state"] == first_run["state"]
    assert rows(publish.read_published(spark, paths.published, "balance_mensual")) == ordered(lakes.balance(later))
    assert rows(publish.read_published(spark, paths.published, "anomalias"), "egreso_id", "severidad") == ordered(
        lakes.high_amounts(later)
    )

    # Nothing is pending now; a further message would be.
    offsets = "topic STRING, partition INT, next_offset BIGINT"
    assert not finance.has_new_data(spark, paths, spark.createDataFrame([("lake.ingresos", 0, 10_001)], offsets))
    assert finance.has_new_data(spark, paths, spark.createDataFrame([("lake.ingresos", 0, 10_002)], offsets))


def test_unreadable_messages_are_set_aside_and_counted(spark, folder, lake):
    paths = finance.Lake(*(f"{folder}/{n}" for n in ("raw", "checkpoint", "state", "curated", "published")))
    send(spark, f"{folder}/topics", lake)
    at = lakes.T0
    broken = [("lake.ingresos", 0, 90_000 + i, at, b"1", v) for i, v in enumerate([b'{"payload":null}', b"not json"])]
    spark.createDataFrame(broken, events.MESSAGE).write.mode("append").parquet(f"{folder}/topics")
    done = finance.daily_run(spark, paths, events.file_events(spark, f"{folder}/topics"), "lake.")["state"]
    assert done["ingresos"] == len(lake["ingresos"]) and done["quarantined ingresos"] == 2
    assert sum(n for name, n in done.items() if name.startswith("quarantined")) == 2
    aside = spark.read.parquet(f"{paths.quarantine}/ingresos")
    assert rows(aside, "offset", "reason", "value") == [
        (90_000, "unreadable envelope", '{"payload":null}'), (90_001, "unreadable envelope", "not json"),
    ]


def test_a_failing_gate_stops_the_run(spark, folder, lake):
    paths = finance.Lake(*(f"{folder}/{n}" for n in ("raw", "checkpoint", "state", "curated", "published")))
    bad = {**lake, "egresos": [dict(lake["egresos"][0], monto=Decimal("-1.00")), *lake["egresos"][1:]]}
    send(spark, f"{folder}/topics", bad)
    with pytest.raises(quality.QualityError, match="range on egresos"):
        finance.daily_run(spark, paths, events.file_events(spark, f"{folder}/topics"), "lake.")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(f"{paths.curated}/balance_mensual")


def test_dashboards(tables, lake):
    pages = finance.dashboards(tables)
    total_in = sum(r["monto"] for r in lake["ingresos"] if r["eliminado_en"] is None)
    assert pages["totales"].first()["inflows"] == total_in
    assert {r[0] for r in rows(pages["dim_usuario"])} == {1, 2, 3}
    months = sorted({r[1] for r in lakes.balance(lake)})
    assert rows(pages["dim_mes"], "mes") == [(m,) for m in months]
    last = pages["balance_acumulado"].orderBy(F.desc("mes")).first()["running_net"]
    assert last == sum(r[4] for r in lakes.balance(lake))
    assert {r[0] for r in rows(pages["anomalias"], "colour")} == {"#C62828", "#F9A825"}
