"""Personal-finance lake: the source tables, the curated contract and the daily run.

Table and column names are those of the captured database and of its consumers, so raw,
state and curated folders of an existing lake can be read and replaced as they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import changes, outliers, quality, reconcile, reports, rollup
from ledgerlake.operators.backlog import landed_offsets, offset_backlog
from ledgerlake.plans import recompute
from ledgerlake.plans.steps import Step, run_steps
from ledgerlake.sinks import publish, segments
from ledgerlake.sinks.layers import write_layer
from ledgerlake.sources.relational import FrameSource, JdbcSource, ParquetSource
from ledgerlake.sources.tables import neutral_names, read_raw_log
from ledgerlake.spec import TableSpec
from ledgerlake.streaming import landing, progress

# Names in the raw layer and the lineage columns of the state layer.
RAW_NAMES = {"table": "tabla", "ingest_date": "fecha", "log_ts": "kafka_ts"}
LINEAGE = ("_ultimo_offset", "_ultima_op")
RAW_LAYOUT = (RAW_NAMES["table"], RAW_NAMES["ingest_date"])
RUN_MARK = "stream STRING, batch BIGINT, completed_at TIMESTAMP"

# Captured tables, with the type each column has in the state layer.
_AUDIT = "creado_en TIMESTAMP, actualizado_en TIMESTAMP, eliminado_en TIMESTAMP"
_CATALOGUE = f"id INT, usuario_id INT, nombre STRING, es_por_defecto BOOLEAN, {_AUDIT}"
_SOURCE_DDL = {
    "usuarios": "id INT, nombre STRING, apellido_p STRING, apellido_m STRING, correo STRING, "
    "fecha_nacimiento DATE, scopes STRING, activo BOOLEAN, creado_en TIMESTAMP, actualizado_en TIMESTAMP",
    "destinos": _CATALOGUE,
    "procedencias": _CATALOGUE,
    "tipos_egreso": _CATALOGUE,
    "tipos_ingreso": _CATALOGUE,
    "frecuencias": f"id INT, nombre STRING, {_AUDIT}",
    "ingresos": "id BIGINT, usuario_id INT, tipo_id INT, procedencia_id INT, frecuencia_id INT, "
    f"monto DECIMAL(12,2), descripcion STRING, fecha_inicio TIMESTAMP, fecha_fin TIMESTAMP, {_AUDIT}",
    "egresos": "id BIGINT, usuario_id INT, tipo_id INT, destino_id INT, frecuencia_id INT, "
    f"monto DECIMAL(12,2), descripcion STRING, fecha_inicio TIMESTAMP, fecha_fin TIMESTAMP, {_AUDIT}",
    "inversiones": "id BIGINT, usuario_id INT, destino_id INT, monto DECIMAL(12,2), objetivo STRING, "
    f"tasa_interes DECIMAL(5,2), fecha_inicio TIMESTAMP, fecha_fin TIMESTAMP, {_AUDIT}",
    "metas": "id BIGINT, usuario_id INT, nombre STRING, monto_objetivo DECIMAL(12,2), "
    f"ahorro_real DECIMAL(12,2), activa BOOLEAN, fecha_inicio TIMESTAMP, fecha_fin TIMESTAMP, {_AUDIT}",
    "fechas_corte_ahorro": "id INT, usuario_id INT, fecha_corte TIMESTAMP, creado_en TIMESTAMP",
}
SOURCE = {
    name: TableSpec(name, ddl, soft_delete="eliminado_en" if "eliminado_en" in ddl else None)
    for name, ddl in _SOURCE_DDL.items()
}

# Curated tables, their keys and the only columns that may be NULL.
_SPEND_TAIL = (
    "total_egresos DECIMAL(18,2), n_egresos BIGINT, total_mes_anterior DECIMAL(18,2), variacion_pct DECIMAL(26,2)"
)
_MAY_BE_NULL = ("total_mes_anterior", "variacion_pct")
CURATED = {
    "balance_mensual": TableSpec(
        "balance_mensual",
        "usuario_id INT, mes DATE, total_ingresos DECIMAL(18,2), total_egresos DECIMAL(18,2), "
        "balance DECIMAL(18,2), n_ingresos BIGINT, n_egresos BIGINT, balance_acumulado DECIMAL(18,2)",
        keys=("usuario_id", "mes"),
        nullable=(),
    ),
    "gasto_por_destino_mensual": TableSpec(
        "gasto_por_destino_mensual",
        f"usuario_id INT, mes DATE, destino_id INT, destino STRING, {_SPEND_TAIL}",
        keys=("usuario_id", "mes", "destino_id"),
        nullable=_MAY_BE_NULL,
    ),
    "gasto_por_tipo_mensual": TableSpec(
        "gasto_por_tipo_mensual",
        f"usuario_id INT, mes DATE, tipo_id INT, tipo STRING, {_SPEND_TAIL}",
        keys=("usuario_id", "mes", "tipo_id"),
        nullable=_MAY_BE_NULL,
    ),
    "anomalias": TableSpec(
        "anomalias",
        "egreso_id BIGINT, usuario_id INT, destino_id INT, destino STRING, fecha DATE, monto DECIMAL(12,2), "
        "n_grupo BIGINT, q1 DECIMAL(18,2), q3 DECIMAL(18,2), iqr DECIMAL(18,2), limite_atipico DECIMAL(18,2), "
        "limite_extremo DECIMAL(18,2), exceso_sobre_limite DECIMAL(18,2), severidad STRING",
        keys=("egreso_id",),
        nullable=(),
    ),
}

# Id and labels of what has no category or method, severities, their colours.
NO_ID = 0
NO_CATEGORY, NO_METHOD = "Sin destino", "Sin tipo"
FENCES = outliers.Fences(mild_name="atipico", extreme_name="extremo")
SEVERITY_COLOURS = {"extremo": "#C62828", "atípico": "#F9A825", "atipico": "#F9A825"}
# Columns that never enter the lake.
NOT_LANDED = {"usuarios": ("password_hash",)}
FREE_TEXT = ("descripcion", "nombre", "apellido_p", "apellido_m", "correo")
# Names of the outlier columns in the curated table.
_OUTLIER_NAMES = {
    "id": "egreso_id",
    "n_group": "n_grupo",
    "mild_fence": "limite_atipico",
    "extreme_fence": "limite_extremo",
    "excess": "exceso_sobre_limite",
    "severity": "severidad",
}
# Rules and references of the captured database.
RANGES = {
    "egresos": {"monto > 0": "monto > 0"},
    "ingresos": {"monto > 0": "monto > 0"},
    "inversiones": {"monto > 0": "monto > 0", "tasa_interes": "tasa_interes BETWEEN 0 AND 100"},
    "metas": {"monto_objetivo > 0": "monto_objetivo > 0", "ahorro_real >= 0": "ahorro_real >= 0"},
}
REFERENCES = [
    ("egresos", "usuario_id", "usuarios"),
    ("egresos", "tipo_id", "tipos_egreso"),
    ("egresos", "destino_id", "destinos"),
    ("egresos", "frecuencia_id", "frecuencias"),
    ("ingresos", "usuario_id", "usuarios"),
    ("ingresos", "tipo_id", "tipos_ingreso"),
    ("ingresos", "procedencia_id", "procedencias"),
    ("ingresos", "frecuencia_id", "frecuencias"),
    ("inversiones", "usuario_id", "usuarios"),
    ("inversiones", "destino_id", "destinos"),
]
UNIQUE = {
    "usuarios": ("correo",),
    "destinos": ("usuario_id", "nombre"),
    "procedencias": ("usuario_id", "nombre"),
    "tipos_egreso": ("usuario_id", "nombre"),
    "tipos_ingreso": ("usuario_id", "nombre"),
    "frecuencias": ("nombre",),
    "fechas_corte_ahorro": ("usuario_id", "fecha_corte"),
}

Tables = Mapping[str, DataFrame]
Source = JdbcSource | ParquetSource | FrameSource


# ------------------------------------------------------------------------------------ state
def state_of(log: DataFrame, table: str, mode: str = "strict") -> DataFrame:
    return changes.current_state(log, SOURCE[table], mode, lineage=LINEAGE)


def rebuild_state(
    log: DataFrame, root: str, mode: str = "strict", parallel: int = 4, quarantine: str | None = None,
    specs: Mapping[str, TableSpec] = SOURCE,
) -> dict[str, int]:
    """Rewrite the state of every captured table; returns the rows of each.

    Each table reads its own partition of the log. The writes are independent jobs, several
    at a time, so that a small table does not wait for a large one. With ``quarantine``, the events
    that can't become state are written to that folder first and counted as well, as
    ``quarantined <table>``: none is lost unseen, also when a bad value then stops the run.
    """
    def write(table: str) -> int:
        return write_layer(changes.current_state(log, specs[table], mode, lineage=LINEAGE), f"{root}/{table}")

    def set_aside(table: str) -> int:
        return write_layer(changes.quarantined(log, specs[table]), f"{quarantine}/{table}")

    with ThreadPoolExecutor(parallel) as pool:
        aside = dict(zip(specs, pool.map(set_aside, specs))) if quarantine else {}
        kept = dict(zip(specs, pool.map(write, specs)))
    return kept | {f"quarantined {table}": n for table, n in aside.items()}


def read_layer(spark: SparkSession, root: str, specs: Mapping[str, TableSpec]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root}/{name}") for name in specs}


# ---------------------------------------------------------------------------------- curated
def active(rows: DataFrame) -> DataFrame:
    return rollup.with_period(rollup.active_rows(rows, "eliminado_en"), "fecha_inicio", alias="mes")


def monthly_balance(state: Tables) -> DataFrame:
    entries = rollup.both_directions(
        active(state["ingresos"]), active(state["egresos"]), ["usuario_id", "mes", "monto"]
    )
    names = ("total_ingresos", "total_egresos", "balance", "n_ingresos", "n_egresos")
    totals = rollup.period_balance(entries, "usuario_id", "mes", "monto", F.col("is_inflow"), names)
    return rollup.running_total(totals, ["usuario_id"], "mes", "balance", "balance_acumulado")


def monthly_spend(state: Tables, dim_id: str, catalogue: str, label: str, missing: str) -> DataFrame:
    totals = rollup.dimension_spend(
        active(state["egresos"]), "usuario_id", "mes", dim_id, "monto", NO_ID, "total_egresos", "n_egresos"
    )
    changed = rollup.period_change(
        totals, ["usuario_id", dim_id], "mes", "total_egresos",
        prior="total_mes_anterior", change="variacion_pct",
    )
    named = rollup.label_from(changed, dim_id, state[catalogue], "id", "nombre", label, missing)
    return named.select(
        "usuario_id", "mes", dim_id, label, "total_egresos", "n_egresos", "total_mes_anterior", "variacion_pct"
    )


def high_amounts(state: Tables, fences: outliers.Fences = FENCES) -> DataFrame:
    rows = rollup.active_rows(state["egresos"], "eliminado_en").withColumn(
        "destino_id", F.coalesce(F.col("destino_id"), F.lit(NO_ID))
    ).withColumn("fecha", F.col("fecha_inicio").cast("date"))
    found = outliers.iqr_outliers(rows, ["usuario_id", "destino_id"], "monto", ["id", "fecha"], fences)
    named = rollup.label_from(
        found, "destino_id", state["destinos"], "id", "nombre", "destino", NO_CATEGORY
    )
    return named.withColumnsRenamed(_OUTLIER_NAMES).select(*CURATED["anomalias"].columns)


def curated(state: Tables) -> dict[str, DataFrame]:
    """The four curated tables."""
    return {
        "balance_mensual": monthly_balance(state),
        "gasto_por_destino_mensual": monthly_spend(state, "destino_id", "destinos", "destino", NO_CATEGORY),
        "gasto_por_tipo_mensual": monthly_spend(state, "tipo_id", "tipos_egreso", "tipo", NO_METHOD),
        "anomalias": high_amounts(state),
    }


def write_curated(tables: Tables, root: str, parallel: int = 4) -> dict[str, int]:
    with ThreadPoolExecutor(parallel) as pool:
        counts = pool.map(lambda name: write_layer(tables[name], f"{root}/{name}"), tables)
        return dict(zip(tables, counts))


# ----------------------------------------------------------------------------------- checks
def state_problems(state: Tables) -> DataFrame:
    """Gate of the state layer: keys, deletes, amounts, and the rules of the source."""
    parts = [
        quality.state_problems(
            rows, name, ["id"], ["monto"] if name in ("ingresos", "egresos") else [], last_op=LINEAGE[1]
        )
        for name, rows in state.items()
    ]
    for name, rules in RANGES.items():
        conditions = {text: F.expr(rule) for text, rule in rules.items()}
        parts.append(quality.rule_problems(state[name], name, ["id"], conditions, "range"))
    for name, column, parent in REFERENCES:
        parts.append(quality.orphan_problems(state[name], name, ["id"], column, state[parent], "id"))
    for name, keys in UNIQUE.items():
        # As in the source, rows with a NULL in the key do not repeat each other.
        known = state[name].dropna(subset=list(keys))
        parts.append(quality.duplicate_problems(known, name, keys))
    return quality.all_problems(parts)


def contract_problems(spark: SparkSession, tables: Tables) -> DataFrame:
    """Exact columns and types, required values, keys, periods and signs."""
    parts = []
    for name, rows in tables.items():
        spec = CURATED[name]
        parts += [
            quality.contract_problems(spark, rows.schema, spec),
            quality.forbidden_columns(spark, rows.schema, name, FREE_TEXT),
            quality.null_problems(rows, name, spec.required),
            quality.duplicate_problems(rows, name, spec.keys),
        ]
        if "mes" in spec.columns:
            signed = [c for c in spec.columns if c.startswith(("total_ing", "total_egr", "n_"))]
            parts += [
                quality.period_start_problems(rows, name, spec.keys, "mes"),
                quality.negative_problems(rows, name, spec.keys, signed),
            ]
    return quality.all_problems(parts)


_SPENDS = {
    "gasto_por_destino_mensual": ("destino_id", "destino", "destinos", NO_CATEGORY),
    "gasto_por_tipo_mensual": ("tipo_id", "tipo", "tipos_egreso", NO_METHOD),
}


def coherence_problems(tables: Tables, state: Tables) -> DataFrame:
    """Balances and breakdowns add up, changes hold, and a second computation agrees."""
    balance = tables["balance_mensual"]
    parts = [
        quality.balance_problems(
            balance, "balance_mensual", "usuario_id", "mes",
            ("total_ingresos", "total_egresos", "balance", "balance_acumulado"),
        ),
        recompute_balance_problems(balance, state),
    ]
    for name, (dim_id, label, catalogue, missing) in _SPENDS.items():
        parts += [
            quality.compare_totals(
                tables[name], balance, ["usuario_id", "mes"], ["total_egresos", "n_egresos"],
                "breakdown", name, ("breakdown", "balance"),
            ),
            quality.change_problems(
                tables[name], name, ["usuario_id", dim_id], "mes", "total_egresos",
                "total_mes_anterior", "variacion_pct",
            ),
            recompute_spend_problems(tables[name], state, name, dim_id, label, catalogue, missing),
        ]
    return quality.all_problems(parts)


def recompute_balance_problems(balance: DataFrame, state: Tables) -> DataFrame:
    sides = {
        side: active(state[side]).select(
            F.col("usuario_id").alias("entity"), F.col("mes").alias("period"), F.col("monto").alias("amount")
        )
        for side in ("ingresos", "egresos")
    }
    expected = recompute.balance(sides["ingresos"], sides["egresos"]).withColumnsRenamed(
        {
            "entity": "usuario_id", "period": "mes", "total_in": "total_ingresos",
            "total_out": "total_egresos", "n_in": "n_ingresos", "n_out": "n_egresos",
            "running_balance": "balance_acumulado",
        }
    )
    return reconcile.recompute_problems(balance, expected, "balance_mensual", CURATED["balance_mensual"])


def recompute_spend_problems(
    spend: DataFrame, state: Tables, name: str, dim_id: str, label: str, catalogue: str, missing: str
) -> DataFrame:
    outflows = active(state["egresos"]).select(
        F.col("usuario_id").alias("entity"), F.col("mes").alias("period"),
        F.col(dim_id).alias("dim_id"), F.col("monto").alias("amount"),
    )
    names = state[catalogue].select("id", F.col("nombre").alias("name"))
    expected = recompute.spend(outflows, names, NO_ID, missing).withColumnsRenamed(
        {
            "entity": "usuario_id", "period": "mes", "dim_id": dim_id, "label": label,
            "total": "total_egresos", "n": "n_egresos", "prior_total": "total_mes_anterior",
            "change_pct": "variacion_pct",
        }
    )
    return reconcile.recompute_problems(spend, expected, name, CURATED[name])


def outlier_problems(found: DataFrame, state: Tables, fences: outliers.Fences = FENCES) -> DataFrame:
    """Rules of the outlier table, its source rows, and the recomputation in SQL."""
    neutral = found.withColumnsRenamed({v: k for k, v in _OUTLIER_NAMES.items()})
    rows = rollup.active_rows(state["egresos"], "eliminado_en")
    neutral_rows = rows.select(
        "id", F.col("usuario_id").alias("entity"), F.coalesce("destino_id", F.lit(NO_ID)).alias("dim_id"), F.col("monto").alias("amount")
    )
    expected = recompute.outliers(
        neutral_rows, fences.min_rows, fences.mild, fences.extreme, fences.mild_name, fences.extreme_name
    )
    return quality.all_problems(
        [
            quality.outlier_rule_problems(neutral, "anomalias", "id", "monto", fences),
            quality.outlier_source_problems(neutral, "anomalias", "id", ["usuario_id", "monto"], rows),
            quality.outlier_recompute_problems(neutral, expected, "anomalias", "id"),
        ]
    )


def source_problems(tables: Tables, state: Tables, source: Source) -> DataFrame:
    """Row counts of every captured table and monthly totals against the source database, which adds up its own rows."""
    balance = tables["balance_mensual"]
    counted = quality.all_problems([source.row_count(name) for name in state if name in source.tables])
    parts = [reconcile.count_problems(reconcile.row_counts(state), counted)]
    for side in ("ingresos", "egresos"):
        totals = source.monthly_totals(side, "usuario_id", "fecha_inicio", "monto", "eliminado_en")
        parts.append(
            reconcile.total_problems(
                balance, "usuario_id", "mes", f"total_{side}", f"n_{side}", totals, f"balance_mensual.{side}"
            )
        )
    return quality.all_problems(parts)


# -------------------------------------------------------------------------------- daily run
@dataclass(frozen=True)
class Lake:
    """Folders of the layers."""

    raw: str
    checkpoint: str
    state: str
    curated: str
    published: str

    @property
    def completed(self) -> str:
        """Which landed batches a complete run has built."""
        return f"{self.checkpoint}_completed"

    @property
    def quarantine(self) -> str:
        """Events that could not become state, per table."""
        return f"{self.state}_quarantine"


def land(messages: DataFrame, prefix: str, lake: Lake, as_segments: bool = False, files: int = 1) -> None:
    """Land the messages of the captured tables under the raw names, without the columns that must stay out.

    ``as_segments`` lands batches that can be compacted, at most ``files`` files for a table and date.
    """
    rows = landing.exclude_columns(landing.landing_rows(messages, prefix, list(SOURCE)), NOT_LANDED)
    rows = rows.withColumnsRenamed(RAW_NAMES)
    if as_segments:
        landing.drain(landing.start_segment_landing(rows, lake.raw, lake.checkpoint, RAW_LAYOUT, files))
    else:
        landing.drain(landing.start_landing(rows, lake.raw, lake.checkpoint, RAW_LAYOUT))


def compact_raw(spark: SparkSession, lake: Lake, least: int = 2, keep: timedelta = timedelta(days=1)) -> tuple[str | None, list[str]]:
    """Put landed segments together and delete those replaced longer ago than ``keep``; both as names."""
    name = landing.compact(spark, lake.raw, RAW_LAYOUT, least)
    return name, segments.expire(spark, lake.raw, keep)


def raw_log(spark: SparkSession, lake: Lake) -> DataFrame:
    """The raw layer under the neutral names, landed as files or as segments."""
    found = segments.read_segments(spark, lake.raw)
    return read_raw_log(spark, lake.raw, RAW_NAMES) if found is None else neutral_names(found, RAW_NAMES)


def has_new_data(spark: SparkSession, lake: Lake, available: DataFrame, prefix: str = "") -> bool:
    """Whether topics below the prefix hold messages that no committed batch of the landing covers.

    A landing from files has no offsets in its checkpoint: there the landed rows tell.
    """
    landed = progress.committed_offsets(spark, lake.checkpoint)
    if landed.isEmpty() and progress.committed_batch(spark, lake.checkpoint) is not None:
        landed = landed_offsets(raw_log(spark, lake))
    return not offset_backlog(available, landed, landing.topic_pattern(prefix)).isEmpty()


def landed_up_to(spark: SparkSession, lake: Lake) -> tuple[str, int] | None:
    """The landing's id and last committed batch, or nothing."""
    batch = progress.committed_batch(spark, lake.checkpoint)
    return None if batch is None else (progress.stream_id(spark, lake.checkpoint) or "", batch)


def is_built(spark: SparkSession, lake: Lake, landed: tuple[str, int]) -> bool:
    """Whether a run that got through all its steps has covered what is landed."""
    marks = read_marks(spark, lake)
    return not marks.filter((F.col("stream") == landed[0]) & (F.col("batch") >= landed[1])).isEmpty()


def read_marks(spark: SparkSession, lake: Lake) -> DataFrame:
    try:
        return spark.read.schema(RUN_MARK).json(lake.completed)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUN_MARK)


def mark_built(spark: SparkSession, lake: Lake, landed: tuple[str, int]) -> None:
    mark = spark.createDataFrame([(*landed, datetime.now(timezone.utc))], RUN_MARK)
    mark.coalesce(1).write.mode("append").json(lake.completed)


HIGH_AMOUNTS = {"anomalias": CURATED["anomalias"]}
MONTHLY = {name: spec for name, spec in CURATED.items() if name not in HIGH_AMOUNTS}


def batch_steps(spark: SparkSession, lake: Lake) -> list[Step]:
    """State, curated tables, outliers and publication, each with its gate."""

    def state() -> Tables:
        return read_layer(spark, lake.state, SOURCE)

    def stored(specs: Mapping[str, TableSpec]) -> Tables:
        return read_layer(spark, lake.curated, specs)

    def build_state() -> dict[str, int]:
        return rebuild_state(raw_log(spark, lake), lake.state, quarantine=lake.quarantine)

    def build(specs: Mapping[str, TableSpec]) -> dict[str, int]:
        tables = curated(state())
        return write_curated({name: tables[name] for name in specs}, lake.curated)

    def monthly_problems() -> DataFrame:
        tables = stored(MONTHLY)
        return contract_problems(spark, tables).unionByName(coherence_problems(tables, state()))

    def high_amount_problems() -> DataFrame:
        tables = stored(HIGH_AMOUNTS)
        return contract_problems(spark, tables).unionByName(outlier_problems(tables["anomalias"], state()))

    return [
        Step("state", build_state, lambda: state_problems(state())),
        Step("curated", lambda: build(MONTHLY), monthly_problems),
        Step("outliers", lambda: build(HIGH_AMOUNTS), high_amount_problems),
        Step(
            "publish",
            lambda: publish.publish(stored(CURATED), lake.published),
            lambda: publish.verify_published(spark, lake.published),
        ),
    ]


def daily_run(
    spark: SparkSession, lake: Lake, messages: DataFrame, prefix: str, force: bool = False, as_segments: bool = False
) -> dict[str, object] | None:
    """Land what is new and rebuild the layers above it; ``None`` where there is nothing to build.

    Landing reads only what no committed batch covers. If no run that passed all its gates is behind the last batch,
    the layers are rebuilt, also when nothing landed this time: a run that failed is made up for. ``force`` rebuilds in any case.
    """
    land(messages, prefix, lake, as_segments)
    landed = landed_up_to(spark, lake)
    if landed is None or (not force and is_built(spark, lake, landed)):
        return None
    results = run_steps(batch_steps(spark, lake))
    mark_built(spark, lake, landed)
    return results


# ---------------------------------------------------------------------------------- reports
def dashboards(tables: Tables) -> dict[str, DataFrame]:
    """The pages of the finance report, unfiltered; filter them with the dimensions."""
    balance, spend = tables["balance_mensual"], tables["gasto_por_destino_mensual"]
    renamed = tables["anomalias"].withColumnsRenamed({"severidad": "severity", "exceso_sobre_limite": "excess"})
    return {
        "dim_usuario": reports.dimension(balance, "usuario_id"),
        "dim_mes": reports.period_dimension(balance, "mes"),
        "totales": reports.kpi_totals(balance, "total_ingresos", "total_egresos"),
        "balance_acumulado": reports.portfolio_running(balance, "mes", "balance"),
        "gasto_por_destino": reports.spend_by_period(spend, "mes", "destino", "total_egresos"),
        "gasto_por_tipo": reports.spend_by_period(tables["gasto_por_tipo_mensual"], "mes", "tipo", "total_egresos"),
        "variacion": reports.change_with_total(spend, "destino", "total_egresos", "total_mes_anterior", by=["mes"]),
        "anomalias": reports.outlier_report(renamed, "egreso_id", SEVERITY_COLOURS).withColumnsRenamed(
            {"severity": "severidad", "excess": "exceso_sobre_limite"}
        ),
    }
