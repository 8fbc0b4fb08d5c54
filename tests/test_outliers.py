from __future__ import annotations

import bisect
import math
import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import outliers
from ledgerlake.operators.ranking import BUCKET_BITS, order_statistics, ordinals
from ledgerlake.plans import recompute
from tests.conftest import rows

D = Decimal
MOVE = "id BIGINT, owner INT, dim INT, amount DECIMAL(12,2), note STRING"


def moves(spark, groups):
    lines, n = [], 0
    for (owner, dim), amounts in groups.items():
        for amount in amounts:
            n += 1
            lines.append((n, owner, dim, None if amount is None else D(amount), "secret"))
    return spark.createDataFrame(lines, MOVE)


def detect(spark, groups, **options):
    found = outliers.iqr_outliers(
        moves(spark, groups), ["owner", "dim"], "amount", ["id"], outliers.Fences(**options)
    )
    return rows(found, "id", "severity", "excess")


BASE = ["10", "11", "12", "13", "14", "15", "16"]


def test_a_group_of_seven_is_not_judged_and_eight_is(spark):
    assert detect(spark, {(1, 1): BASE[:6] + ["900"]}) == []
    # q1 = 11.75, q3 = 15.25, fence = 20.50
    assert detect(spark, {(1, 1): BASE + ["900"]}) == [(8, "extreme", D("879.50"))]


def test_amounts_on_a_fence_are_inside_it(spark):
    assert detect(spark, {(1, 1): BASE + ["20.50"]}) == []
    assert detect(spark, {(1, 1): BASE + ["20.51"]}) == [(8, "mild", D("0.01"))]
    assert detect(spark, {(1, 1): BASE + ["25.75"]}) == [(8, "mild", D("5.25"))]
    assert detect(spark, {(1, 1): BASE + ["25.76"]}) == [(8, "extreme", D("5.26"))]


def test_a_flat_group_is_not_judged(spark):
    assert detect(spark, {(1, 1): ["5"] * 9 + ["900"]}) == []


def test_null_amounts_count_as_rows_but_not_as_values(spark):
    # Seven values: q1 = 11.50, q3 = 14.50, fence = 19.00
    assert detect(spark, {(1, 1): BASE[:6] + [None, "900"]}) == [(8, "extreme", D("881.00"))]
    assert detect(spark, {(1, 1): [None] * 9}) == []


def test_low_amounts_are_never_outliers(spark):
    assert detect(spark, {(1, 1): ["1000", "1001", "1002", "1003", "1004", "1005", "1006", "1"]}) == []


def test_half_cents_round_up(spark):
    amounts = ["0.01", "0.02", "0.03", "0.04", "0.05", "0.06", "0.07", "0.08", "0.10"]
    stats = outliers.group_fences(
        moves(spark, {(1, 1): amounts[:7]}), ["owner", "dim"], "amount"
    )
    assert rows(stats, "q1", "q3", "mild_fence") == [(D("0.0250"), D("0.0550"), D("0.100000"))]
    found = outliers.iqr_outliers(
        moves(spark, {(1, 1): amounts[:7] + ["9.00"]}), ["owner", "dim"], "amount", ["id"]
    )
    assert rows(found, "q1", "q3") == [(D("0.03"), D("0.06"))]


def test_free_text_stays_behind(spark):
    found = outliers.iqr_outliers(moves(spark, {(1, 1): BASE + ["900"]}), ["owner", "dim"], "amount", ["id"])
    assert "note" not in found.columns


def brute_force(groups):
    """Outliers in exact arithmetic."""
    found, n = [], 0
    for amounts in groups.values():
        numbered = []
        for amount in amounts:
            n += 1
            numbered.append((n, amount))
        values = sorted(Fraction(a) for _, a in numbered if a is not None)

        def quartile(p):
            place = (len(values) - 1) * Fraction(p)
            low = math.floor(place)
            return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)

        if len(numbered) < 8 or not values:
            continue
        q1, q3 = quartile(Fraction(1, 4)), quartile(Fraction(3, 4))
        mild, extreme = q3 + Fraction(3, 2) * (q3 - q1), q3 + 3 * (q3 - q1)
        if q3 > q1:
            found += [
                (i, "extreme" if Fraction(a) > extreme else "mild")
                for i, a in numbered
                if a is not None and Fraction(a) > mild
            ]
    return sorted(found, key=repr)


def test_random_groups_against_exact_arithmetic(spark):
    chance = random.Random(5)
    groups = {}
    for g in range(40):
        size = chance.choice([3, 7, 8, 9, 20, 60, 200])
        amounts = [f"{chance.lognormvariate(4, 1.2):.2f}" for _ in range(size)]
        groups[(g, g % 3)] = [None if chance.random() < 0.03 else a for a in amounts]
    found = [(i, s) for i, s, _ in detect(spark, groups)]
    assert found and found == brute_force(groups)


def test_one_group_may_hold_most_rows(spark):
    chance = random.Random(6)
    groups = {(1, 1): [f"{chance.lognormvariate(4, 1):.2f}" for _ in range(3000)]}
    groups |= {(o, 2): [f"{chance.lognormvariate(4, 1):.2f}" for _ in range(10)] for o in range(2, 60)}
    assert [(i, s) for i, s, _ in detect(spark, groups)] == brute_force(groups)


def test_amounts_at_the_limit_of_money(spark):
    top = 9_999_999_999_999_000  # units of decimal(18,2)
    amounts = [f"{top - 10**15 + i * 7 + chance % 3}.{chance:02d}" for i, chance in enumerate(range(11, 31))] + [f"{top}.99"]
    frame = spark.createDataFrame([(n + 1, 1, 1, D(a)) for n, a in enumerate(amounts)], "id BIGINT, owner INT, dim INT, amount DECIMAL(18,2)")
    found = outliers.iqr_outliers(frame, ["owner", "dim"], "amount", ["id"])
    assert rows(found, "id", "severity") == brute_force({(1, 1): amounts})
    values = sorted(Fraction(a) for a in amounts)
    stats = outliers.group_fences(frame, ["owner", "dim"], "amount").first()
    assert (Fraction(stats.q1), Fraction(stats.q3)) == (values[5], values[15])


def test_recomputation_in_sql_agrees(spark):
    chance = random.Random(8)
    groups = {(g, 1): [f"{chance.lognormvariate(4, 1.5):.2f}" for _ in range(chance.choice([5, 30, 90]))] for g in range(12)}
    table = moves(spark, groups)
    names = ["id", "n_group", "q1", "q3", "iqr", "mild_fence", "extreme_fence", "excess", "severity"]
    found = outliers.iqr_outliers(table, ["owner", "dim"], "amount", ["id"])
    again = recompute.outliers(table.selectExpr("id", "owner AS entity", "dim AS dim_id", "amount"), 8, "1.5", "3.0", "mild", "extreme")
    assert rows(found, *names) == rows(again, *names) != []


def test_run_summary(spark):
    groups = {(1, 1): BASE + ["900"], (1, 2): ["5"] * 9, (2, 1): ["1", "2"]}
    table = moves(spark, groups)
    stats = outliers.group_fences(table, ["owner", "dim"], "amount")
    found = outliers.iqr_outliers(table, ["owner", "dim"], "amount", ["id"])
    assert dict(rows(outliers.run_summary(stats, found))) == {
        "n_rows": 19, "n_groups": 3, "n_judged": 1, "n_too_small": 1, "n_flat": 1,
        "n_mild": 0, "n_extreme": 1, "n_outliers": 1,
    }


def test_a_run_is_summarised_from_fences_computed_once(spark):
    chance = random.Random(4)
    groups = {(g, g % 2): [f"{chance.lognormvariate(4, 1.5):.2f}" for _ in range(chance.choice([5, 30, 90]))] + [None] for g in range(9)}
    table = moves(spark, groups | {(50, 1): [None, None], (51, 1): ["3"] * 9})
    group = ["owner", "dim"]
    wanted = outliers.run_summary(outliers.group_fences(table, group, "amount"), outliers.iqr_outliers(table, group, "amount", ["id"]))
    found = outliers.summarise_run(table, group, "amount")
    assert rows(found) == rows(wanted) and dict(rows(found))["n_groups"] == 11
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1


def test_amounts_of_a_large_group_are_ranked_in_parts(spark):
    """A group with most rows and distinct amounts: no window holds more of it than one value bucket."""
    amounts = [f"{i * 97 % 4001 * 1000}.{i % 100:02d}" for i in range(4001)]
    frame = moves(spark, {(1, 1): amounts, (2, 2): BASE})
    cents = frame.select("owner", (F.col("amount") * 100).cast("bigint").alias("c"))
    biggest = cents.groupBy("owner", F.shiftright("c", BUCKET_BITS).alias("b")).count().agg(F.max("count")).first()[0]
    assert biggest < 100
    stats = {r.owner: r for r in outliers.group_fences(frame, ["owner", "dim"], "amount").collect()}
    values = sorted(Fraction(a) for a in amounts)
    assert (Fraction(stats[1].q1), Fraction(stats[1].q3)) == (values[1000], values[3000])


def test_sketched_quartiles_are_within_the_stated_rank_error(spark):
    chance = random.Random(9)
    groups = {(1, 1): [f"{chance.lognormvariate(5, 2):.2f}" for _ in range(30000)], (2, 1): [f"{i}.00" for i in range(50)], (3, 1): [None] * 9}
    table = moves(spark, groups).repartition(5).withColumn("part", F.col("id") % 7)
    merged = outliers.merged_sketches(outliers.quartile_sketches(table, ["owner", "dim", "part"], "amount"), ["owner", "dim"])
    fences = {r.owner: r for r in outliers.sketched_fences(merged, ["owner", "dim"]).collect()}
    values = sorted(Fraction(a) for a in groups[(1, 1)])
    for share, found in ((0.25, fences[1].q1), (0.75, fences[1].q3)):
        assert abs(bisect.bisect_left(values, Fraction(found)) / 30000 - share) <= outliers.RANK_ERROR
    assert fences[1].n_group == 30000 and abs(fences[2].q1 - 12) <= 1 and fences[3].q1 is None and fences[3].n_group == 9


# ----------------------------------------------------------------------------------- ranks
def test_ordinals_equal_row_number_for_any_bucket_size(spark):
    chance = random.Random(3)
    lines = [(chance.choice([1, 1, 1, 2, 3]), chance.randint(-50, 500), i) for i in range(400)]
    frame = spark.createDataFrame(lines, "k INT, o BIGINT, tie INT")
    counters, wanted = defaultdict(int), []
    for key, order, tie in sorted(lines):
        counters[key] += 1
        wanted.append((key, order, tie, counters[key]))
    for bits in (0, 3, 20):
        found = ordinals(frame, ["k"], "o", ["tie"], bits=bits)
        assert sorted(tuple(r) for r in found.collect()) == wanted


def test_order_statistics_equal_a_sorted_list(spark):
    chance = random.Random(4)
    lines = [(chance.choice(["a", "a", "b", None]), chance.randint(-300, 3000)) for _ in range(500)] + [("c", None)]
    frame = spark.createDataFrame(lines, "k STRING, v BIGINT")
    values = defaultdict(list)
    for key, value in lines:
        if value is not None:
            values[key].append(value)
    n = F.col("_n")
    ranks = {"low": F.lit(0), "mid": F.floor((n - 1) / 2), "high": n - 1}
    for bits in (0, 4, 20):
        found = {r["k"]: tuple(r)[1:] for r in order_statistics(frame, ["k"], "v", ranks, bits=bits).collect()}
        assert found == {
            k: (len(v), min(v), sorted(v)[(len(v) - 1) // 2], max(v)) for k, v in values.items()
        }
