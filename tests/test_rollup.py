from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import money, periods
from ledgerlake.operators import rollup
from tests.conftest import rows

D = Decimal
ENTRY = "owner INT, period DATE, amount DECIMAL(12,2), is_inflow BOOLEAN, dim INT"
JAN, FEB, MAR, APR = (dt.date(2026, m, 1) for m in (1, 2, 3, 4))


def entries(spark, *lines):
    return spark.createDataFrame([(*line, None)[:5] for line in lines], ENTRY)


def balance(spark, *lines):
    return rollup.period_balance(entries(spark, *lines), "owner", "period", "amount", F.col("is_inflow"))


@pytest.mark.parametrize(
    "instant, unit, start",
    [
        (dt.datetime(2026, 1, 31, 23, 59, 59), "month", JAN),
        (dt.datetime(2026, 2, 1), "month", FEB),
        (dt.datetime(2025, 12, 31, 23, 59, 59), "year", dt.date(2025, 1, 1)),
        (dt.datetime(2026, 5, 5), "quarter", APR),
        (dt.datetime(2026, 1, 4), "week", dt.date(2025, 12, 29)),
        (dt.datetime(2026, 1, 4, 8), "day", dt.date(2026, 1, 4)),
        (None, "month", None),
    ],
)
def test_period_bucket(spark, instant, unit, start):
    frame = spark.createDataFrame([(instant,)], "at TIMESTAMP")
    assert frame.select(periods.bucket(F.col("at"), unit)).first()[0] == start


@pytest.mark.parametrize("unit", ["day", "week", "month", "quarter", "year"])
def test_period_index_is_consecutive(spark, unit):
    days = spark.range(-800, 800).select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    starts = days.select(periods.bucket(F.col("d"), unit).alias("p")).distinct()
    moved = starts.select(
        periods.index(F.col("p"), unit).alias("a"), periods.index(periods.shift(F.col("p"), 1, unit), unit).alias("b")
    )
    assert moved.filter("b - a != 1").isEmpty()


def test_balance_fills_the_absent_side_with_zero(spark):
    found = balance(spark, (1, JAN, D("10.00"), True), (1, FEB, D("4.00"), False), (1, FEB, D("6.00"), False))
    assert rows(found) == [
        (1, JAN, D("10.00"), D("0.00"), D("10.00"), 1, 0),
        (1, FEB, D("0.00"), D("10.00"), D("-10.00"), 0, 2),
    ]
    assert [f.dataType.simpleString() for f in found.schema.fields[2:]] == ["decimal(18,2)"] * 3 + ["bigint"] * 2


def test_balance_has_one_row_for_an_unknown_period(spark):
    found = balance(spark, (1, None, D("10.00"), True), (1, None, D("4.00"), False))
    assert rows(found) == [(1, None, D("10.00"), D("4.00"), D("6.00"), 1, 1)]


def test_null_amounts_count_but_add_nothing(spark):
    assert rows(balance(spark, (1, JAN, None, True)), "total_in", "n_in") == [(D("0.00"), 1)]


def test_running_total_has_no_gap_fill_and_starts_anew_per_entity(spark):
    base = balance(
        spark, (1, MAR, D("3.00"), True), (1, JAN, D("1.00"), True), (2, JAN, D("7.00"), False), (1, None, D("2.00"), True)
    )
    found = rollup.running_total(base, ["owner"], "period", "balance", "run")
    assert rows(found, "owner", "period", "run") == [
        (1, None, D("2.00")), (1, JAN, D("3.00")), (1, MAR, D("6.00")), (2, JAN, D("-7.00")),
    ]
    assert found.schema["run"].dataType.simpleString() == "decimal(18,2)"


def test_closing_value(spark):
    base = balance(spark, (1, MAR, D("3.00"), True), (1, JAN, D("1.00"), True))
    assert rows(rollup.closing_value(base, "owner", "period", "balance", "last")) == [(1, MAR, D("3.00"))]


def test_spend_groups_missing_ids_under_the_sentinel(spark):
    spent = entries(
        spark, (1, JAN, D("1.00"), False, None), (1, JAN, D("2.00"), False, 0), (1, JAN, D("4.00"), False, 77), (1, JAN, D("8.00"), False, 3)
    )
    names = spark.createDataFrame([(3, "Rent"), (4, "Food")], "id INT, name STRING")
    totals = rollup.dimension_spend(spent, "owner", "period", "dim", "amount", 0)
    found = rollup.label_from(totals, "dim", names, "id", "name", "label", "None")
    assert rows(found, "dim", "label", "total", "n") == [
        (0, "None", D("3.00"), 2), (3, "Rent", D("8.00"), 1), (77, "None", D("4.00"), 1),
    ]


CHANGE = "owner INT, dim INT, period DATE, total DECIMAL(18,2)"
CASES = {
    "previous calendar month": ([(1, 1, JAN, "50.00"), (1, 1, FEB, "40.00")], (FEB, D("50.00"), D("-20.00"))),
    "year boundary": ([(1, 1, dt.date(2025, 12, 1), "3.00"), (1, 1, JAN, "4.00")], (JAN, D("3.00"), D("33.33"))),
    "gap month": ([(1, 1, JAN, "50.00"), (1, 1, MAR, "40.00")], (MAR, None, None)),
    "zero prior": ([(1, 1, JAN, "0.00"), (1, 1, FEB, "40.00")], (FEB, D("0.00"), None)),
    "half up": ([(1, 1, JAN, "800.00"), (1, 1, FEB, "801.00")], (FEB, D("800.00"), D("0.13"))),
    "half up below zero": ([(1, 1, JAN, "800.00"), (1, 1, FEB, "799.00")], (FEB, D("800.00"), D("-0.13"))),
    "another dimension": ([(1, 2, JAN, "50.00"), (1, 1, FEB, "40.00")], (FEB, None, None)),
    "no entity": ([(None, 1, JAN, "50.00"), (None, 1, FEB, "40.00")], (FEB, None, None)),
    "no period": ([(1, 1, None, "50.00")], (None, None, None)),
}


@pytest.mark.parametrize("name", list(CASES))
@pytest.mark.parametrize("operator", [rollup.period_change, rollup.period_change_by_join])
def test_period_change(spark, name, operator):
    lines, wanted = CASES[name]
    frame = spark.createDataFrame([(o, d, p, D(t)) for o, d, p, t in lines], CHANGE)
    found = operator(frame, ["owner", "dim"], "period", "total")
    assert wanted in rows(found, "period", "prior_total", "change_pct")
    assert found.schema["change_pct"].dataType.simpleString() == "decimal(26,2)"


def test_period_change_by_quarter(spark):
    frame = spark.createDataFrame([(1, 1, JAN, D("2.00")), (1, 1, APR, D("3.00"))], CHANGE)
    found = rollup.period_change(frame, ["owner", "dim"], "period", "total", unit="quarter")
    assert (APR, D("2.00"), D("50.00")) in rows(found, "period", "prior_total", "change_pct")


def test_span_profile(spark):
    lines = [
        ("a", dt.datetime(2026, 1, 5), dt.datetime(2026, 1, 30), 1, 1),
        ("a", dt.datetime(2026, 1, 5), dt.datetime(2026, 2, 1), None, None),
        ("a", dt.datetime(2026, 1, 5), None, 2, 1),
    ]
    frame = spark.createDataFrame(lines, "g STRING, s TIMESTAMP, e TIMESTAMP, r INT, d INT")
    assert rows(rollup.span_profile(frame, "g", "s", "e", "r", "d")) == [("a", 3, 2, 2, 1, 1)]


@pytest.mark.parametrize(
    "amount, text",
    [("1179009.35", "$1,179,009.35"), ("-67157.99", "-$67,157.99"), ("0.00", "$0.00"), ("-0.05", "-$0.05")],
)
def test_money_text(spark, amount, text):
    frame = spark.createDataFrame([(D(amount),)], "a DECIMAL(18,2)")
    assert frame.select(money.display(F.col("a"))).first()[0] == text
