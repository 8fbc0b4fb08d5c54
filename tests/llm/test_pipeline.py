"""Stages on the sample tables, and the queries that SQL can express against it."""

from __future__ import annotations

import numpy as np
import pytest

import __spark_entry__ as entries
import corpus_pipeline as p
from ledgerlake.llm import oracles, queries
from ledgerlake.llm import token_shards
from ledgerlake.llm.common import materialise
from ledgerlake.llm.string_tiling import Tiling, plain_words
from tests.conftest import SMOKE
from tests.llm.conftest import low_words
from tests.llm.test_ngram_join import plain_components
from tests.llm.test_string_tiling import plain_tiles
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMOKE), connect(SMOKE), oracles.ORACLES[name]) is None


def test_queries_are_registered():
    assert {f"op{n}_" for n in range(1, 11)} == {name.partition("_")[0] + "_" for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entries.queries()) and set(oracles.ORACLES) <= set(entries.oracle_sql())


def test_stages(spark):
    documents = spark.read.parquet(SMOKE + "/documents.parquet")
    columns, rows = documents.columns, {}
    for name, stage in p.STAGES:
        documents = materialise(stage(spark, documents, SMOKE), "test")
        rows[name] = documents.collect()
        if name != "token shards":
            assert documents.columns == columns
    quality, join, clean, mixed, sequences = rows.values()
    verdicts = {r.doc_id: r.kept for r in queries.QUERIES["op2_quality_rules"](spark, SMOKE).collect()}
    assert sorted(r.doc_id for r in quality) == sorted(k for k, kept in verdicts.items() if kept)
    components = {r[2] for r in plain_components([(r.doc_id, r.text) for r in quality if low_words(r.text)], 5, 80)}
    assert sorted(r.doc_id for r in join) == sorted(components)
    items = [plain_words(r.text) for r in spark.read.parquet(SMOKE + "/benchmark.parquet").collect()]
    items = [i for i in items if len(i) >= Tiling().least]
    kept = {r.doc_id for r in clean}
    for r in join:
        tokens = plain_words(r.text)
        runs = {tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)}
        near = [i for i in items if any(tuple(i[k : k + 5]) in runs for k in range(len(i) - 4))]
        hit = any(100 * sum(n for *_, n in plain_tiles(i, tokens, 5)) >= 60 * len(i) for i in near)
        assert hit != (r.doc_id in kept)
    assert {r.doc_id for r in mixed} <= kept and len(mixed) > 0.8 * len(clean)
    vocabulary = open(token_shards.VOCABULARY, "rb").read()
    assert sum(r.n_tokens for r in sequences) == sum(len(token_shards.encode(r.text, vocabulary)) + 1 for r in mixed)
    assert sorted(r.slot for r in sequences) == list(range(len(sequences)))
    assert np.unique([d for r in sequences for d in r.doc_ids]).tolist() == sorted({r.doc_id for r in mixed})
