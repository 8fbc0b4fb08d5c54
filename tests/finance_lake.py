"""A small finance lake with the hard cases, and its curated tables by plain arithmetic."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from ledgerlake.plans import finance

T0 = dt.datetime(2026, 1, 1)
AUDIT = {"creado_en": T0, "actualizado_en": T0, "eliminado_en": None}


def build(seed: int = 19) -> dict[str, list[dict]]:
    """Rows of every captured table."""
    chance = random.Random(seed)
    lake: dict[str, list[dict]] = {name: [] for name in finance.SOURCE}

    def add(table, **values):
        lake[table].append({c: values.get(c) for c in finance.SOURCE[table].columns})

    for user in (1, 2, 3):
        add("usuarios", id=user, nombre=f"n{user}", apellido_p="p", apellido_m="m", correo=f"u{user}@example.org",
            fecha_nacimiento=dt.date(1990, 1, user), scopes="[]", activo=True, creado_en=T0, actualizado_en=T0)
        add("inversiones", id=user, usuario_id=user, destino_id=1, monto=Decimal("100.00"), objetivo="o",
            tasa_interes=Decimal("7.50"), fecha_inicio=T0, **AUDIT)
        add("metas", id=user, usuario_id=user, nombre="m", monto_objetivo=Decimal("10.00"),
            ahorro_real=Decimal("0.00"), activa=True, fecha_inicio=T0, **AUDIT)
        add("fechas_corte_ahorro", id=user, usuario_id=user, fecha_corte=T0, creado_en=T0)
    for table, names in {
        "destinos": ["Home", "Food", "Travel", "Health"], "procedencias": ["Job"],
        "tipos_egreso": ["Cash", "Card", "Wire"], "tipos_ingreso": ["Fixed", "Other"],
    }.items():
        for i, name in enumerate(names, 1):
            add(table, id=i, nombre=name, es_por_defecto=True, **AUDIT)
    add("frecuencias", id=1, nombre="Monthly", **AUDIT)
    # A catalogue row that was soft-deleted still gives its name.
    lake["destinos"][3]["eliminado_en"] = T0

    def movement(table, at, amount, deleted=False, **values):
        add(table, id=len(lake[table]) + 1, monto=Decimal(amount), descripcion="private", fecha_inicio=at,
            **{**AUDIT, "eliminado_en": T0 if deleted else None, "tipo_id": 1, **values})

    for user in (1, 2, 3):
        for month in range(1, 10):
            if user == 3 and month in (3, 4):
                continue  # months with outflows only
            at = dt.datetime(2026, month, chance.randint(1, 28), 9)
            movement("ingresos", at, f"{chance.randint(900, 2000)}.25", usuario_id=user, procedencia_id=1)
    movement("ingresos", dt.datetime(2026, 5, 5), "5000.00", deleted=True, usuario_id=1, procedencia_id=1)
    movement("ingresos", dt.datetime(2025, 12, 31, 23, 59, 59), "11.11", usuario_id=2)
    movement("ingresos", dt.datetime(2026, 1, 1), "22.22", usuario_id=2)
    for _ in range(260):
        at = dt.datetime(2026, chance.randint(1, 9), chance.randint(1, 28), chance.randint(0, 23))
        movement(
            "egresos", at, f"{chance.lognormvariate(5, 0.8):.2f}", deleted=chance.random() < 0.06,
            usuario_id=chance.randint(1, 3), tipo_id=chance.randint(1, 3), destino_id=chance.choice([1, 2, 3, 4, None]),
        )
    movement("egresos", dt.datetime(2026, 7, 15, 12), "75000.00", usuario_id=2, destino_id=4)
    movement("egresos", dt.datetime(2026, 3, 31, 23, 59, 59), "43.21", usuario_id=3, destino_id=3, tipo_id=2)
    movement("egresos", dt.datetime(2026, 4, 1), "56.78", usuario_id=3, destino_id=3, tipo_id=2)
    return lake


def unknown_ids(lake):
    """The lake with an outflow whose category and method are not in the catalogues."""
    template = next(r for r in lake["egresos"] if r["eliminado_en"] is None)
    extra = {**template, "id": 5000, "destino_id": 77, "tipo_id": 99, "monto": Decimal("32.10")}
    return {**lake, "egresos": [*lake["egresos"], extra]}


def frames(spark, lake) -> dict:
    """State tables as DataFrames, with lineage columns."""
    result = {}
    for name, rows in lake.items():
        spec = finance.SOURCE[name]
        ddl = f"{spec.ddl}, _ultimo_offset BIGINT, _ultima_op STRING"
        data = [(*[r[c] for c in spec.columns], i, "r") for i, r in enumerate(rows)]
        result[name] = spark.createDataFrame(data, ddl)
    return result


# -------------------------------------------------------------------------- plain arithmetic
def _cents(value: Fraction) -> Decimal:
    return (Decimal(value.numerator) / Decimal(value.denominator)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def _alive(rows):
    return [r for r in rows if r["eliminado_en"] is None]


def _month(r):
    return r["fecha_inicio"].date().replace(day=1)


def _previous(month):
    return (month - dt.timedelta(days=1)).replace(day=1)


def balance(lake):
    sums = defaultdict(lambda: [Decimal("0.00"), Decimal("0.00"), 0, 0])
    for side, table in enumerate(("ingresos", "egresos")):
        for r in _alive(lake[table]):
            cell = sums[(r["usuario_id"], _month(r))]
            cell[side] += r["monto"]
            cell[2 + side] += 1
    result, running = [], defaultdict(Decimal)
    for (user, month), (total_in, total_out, n_in, n_out) in sorted(sums.items()):
        running[user] += total_in - total_out
        result.append((user, month, total_in, total_out, total_in - total_out, n_in, n_out, running[user]))
    return result


def spend(lake, column, catalogue, missing):
    names = {r["id"]: r["nombre"] for r in lake[catalogue]}
    sums = defaultdict(lambda: [Decimal("0.00"), 0])
    for r in _alive(lake["egresos"]):
        cell = sums[(r["usuario_id"], _month(r), r[column] or 0)]
        cell[0] += r["monto"]
        cell[1] += 1
    result = []
    for (user, month, dim), (total, n) in sums.items():
        prior = sums[(user, _previous(month), dim)][0] if (user, _previous(month), dim) in sums else None
        change = _cents((Fraction(total) - Fraction(prior)) * 100 / Fraction(prior)) if prior else None
        result.append((user, month, dim, names.get(dim, missing), total, n, prior, change))
    return result


def high_amounts(lake):
    """(id, severity) of the outliers."""
    groups = defaultdict(list)
    for r in _alive(lake["egresos"]):
        groups[(r["usuario_id"], r["destino_id"] or 0)].append(r)
    found = []
    for rows in groups.values():
        values = sorted(Fraction(r["monto"]) for r in rows)
        if len(values) < 8:
            continue

        def quartile(p, values=values):
            place = (len(values) - 1) * p
            low = int(place)
            return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)

        q1, q3 = quartile(Fraction(1, 4)), quartile(Fraction(3, 4))
        for r in rows:
            if q3 > q1 and Fraction(r["monto"]) > q3 + Fraction(3, 2) * (q3 - q1):
                extreme = Fraction(r["monto"]) > q3 + 3 * (q3 - q1)
                found.append((r["id"], "extremo" if extreme else "atipico"))
    return found
