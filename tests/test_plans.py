"""Physical plans: what is pruned, what is shuffled and what never happens."""

from __future__ import annotations

import random
import re

import pytest

from ledgerlake.operators import changes, quality
from ledgerlake.plans import sample_tables as t
from ledgerlake.plans import volume
from ledgerlake.sinks.layers import write_layer
from tests.conftest import SMOKE, rows


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_log(spark):
    import tempfile

    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/log"
    write_layer(t.full_log(spark, SMOKE), path, partition_by=["table", "ingest_date"], cluster_by=["table"])
    return spark.read.parquet(path)


def test_state_prunes_partitions_and_keys_and_parses_once(stored_log):
    text = plan(changes.current_state(stored_log, t.ORDERS_LEDGER))
    assert re.search(r"PartitionFilters: \[[^\]]*table#\d+ = orders_ledger", text)
    assert text.count("WindowGroupLimit") == 2  # before and after the only shuffle
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("from_json") == 1
    assert "topic" not in text  # unused columns are not read


def test_renamed_raw_columns_still_prune_partitions(spark, folder):
    from ledgerlake.plans import finance
    from ledgerlake.sources.tables import read_raw_log

    raw = volume.catalogue_log(spark, "destinos", 3).withColumnsRenamed(finance.RAW_NAMES)
    write_layer(raw, f"{folder}/raw", partition_by=["tabla", "fecha"])
    log = read_raw_log(spark, f"{folder}/raw", finance.RAW_NAMES)
    text = plan(finance.state_of(log, "destinos"))
    assert re.search(r"PartitionFilters: \[[^\]]*tabla#\d+ = destinos", text)


@pytest.mark.parametrize("operator", [changes.change_counts, changes.describe_changes])
def test_log_operators_parse_once(stored_log, operator):
    assert plan(operator(stored_log)).count("from_json") == 1


def test_balance_needs_one_shuffle_per_grouping(spark):
    text = plan(t.balance(spark, SMOKE))
    assert text.count("Exchange hashpartitioning") == 2  # (owner, period), then owner
    assert "Join" not in text
    assert "PushedFilters" in text and "o_totalprice" in text


def test_breakdown_comparison_has_no_join(spark):
    frame = t.balance(spark, SMOKE)
    found = quality.compare_totals(frame, frame, ["owner_id", "period"], ["total_in"], "c", "t")
    assert "Join" not in plan(found)


def test_raw_profile_reads_payloads_only_to_find_empty_ones(stored_log):
    text = plan(changes.raw_profile(stored_log))
    assert text.count("ReadSchema: struct<value:string>") == text.count("PushedFilters: [IsNull(value)]") == 1
    assert text.count("ReadSchema: struct<>") == 1


def test_outliers_read_amounts_twice(spark):
    """Once for the fences and once to be judged; no broadcast is forced."""
    found = t.found_outliers(spark, SMOKE)
    assert "broadcast" not in found._jdf.queryExecution().logical().toString().lower()
    found.collect()
    assert plan(found).split("Initial Plan")[0].count("FileScan") <= 3  # the catalogue as well


# ---------------------------------------------------------------------------------- volume
ROWS = 3000


@pytest.fixture(scope="module")
def curated(spark):
    from ledgerlake.plans import finance

    log = volume.volume_log(spark, ROWS)
    state = {name: finance.state_of(log, name) for name in finance.SOURCE}
    return {n: f for n, f in finance.curated(state).items() if n != "anomalias"}


def test_volume_log_has_the_expected_events(spark):
    n_small = volume.OWNERS + sum(volume.CATALOGUES.values())
    assert volume.volume_log(spark, ROWS).count() == round(1.17 * (ROWS + ROWS // 5)) + n_small


def test_curated_figures_follow_from_the_formulas(curated):
    assert volume.volume_problems(curated, ROWS).isEmpty()


def test_wrong_figures_are_noticed(curated):
    assert not volume.volume_problems(curated, ROWS + 50).isEmpty()
    short = {n: f.filter("usuario_id != 7") for n, f in curated.items()}
    tables = {r[0] for r in rows(volume.volume_problems(short, ROWS), "table")}
    assert len(tables) == 4


def test_a_key_with_a_third_of_all_events_gives_the_same_state(spark):
    """A hot row: one id owns a third of the log, in three partitions."""
    from tests.test_changes import SPEC, event, log, row

    chance = random.Random(2)
    messages, last = [], {}
    for offset in range(900):
        id_ = 1 if chance.random() < 0.34 else chance.randint(2, 400)
        amount = f"{offset}.00"
        messages.append((offset % 3, offset, event("u", row(id_), row(id_, amount))))
        last[id_] = offset
    chance.shuffle(messages)
    found = changes.current_state(log(spark, *messages).repartition(6), SPEC)
    assert {r["id"]: int(r["amount"]) for r in found.collect()} == last
