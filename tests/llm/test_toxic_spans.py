from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries
from ledgerlake.llm import toxic_spans as t

LABELS = "doc_id long, quality int, toxic int, text string, labelled string, fold int, score double"
MILD = ("river", "mill", "keeper", "barge", "rain", "town", "bridge", "bell", "supper", "sleep", "garden", "stone", "window", "paper")
HARSH = ("gruk", "grukling", "grukest", "blarg")


def brute_marginals(scores, turns):
    """Probability of tag 1 at every place, by all sequences of tags."""
    total, hit = 0.0, np.zeros(len(scores))
    for tags in itertools.product((0, 1), repeat=len(scores)):
        weight = np.exp(sum(s * tag for s, tag in zip(scores, tags)) + sum(turns[a][b] for a, b in zip(tags, tags[1:])))
        total += weight
        hit += weight * np.array(tags)
    return hit / total


@pytest.mark.parametrize("seed", range(4))
def test_marginals_equal_all_sequences(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(0, 9, 12)
    scores, turns = draw.normal(0, 3, lengths.sum()), draw.normal(0, 2, (2, 2))
    found, at = t.marginals(scores, lengths, turns), 0
    for n in lengths:
        assert np.allclose(found[at : at + n], brute_marginals(scores[at : at + n], turns) if n else [], atol=1e-9)
        at += n


def test_marginals_of_a_very_long_text_equal_the_plain_recursion():
    draw = np.random.default_rng(5)
    count, turns = 5000, draw.normal(0, 2, (2, 2))
    scores = draw.normal(-1, 4, count)
    ahead, behind = np.zeros((count, 2)), np.ones((count, 2))
    for i in range(count):
        step = (ahead[i - 1] @ np.exp(turns) if i else np.ones(2)) * np.exp([0, scores[i]])
        ahead[i] = step / step.sum()
    for i in range(count - 2, -1, -1):
        step = np.exp(turns) @ (np.exp([0, scores[i + 1]]) * behind[i + 1])
        behind[i] = step / step.sum()
    both = ahead * behind
    assert np.allclose(t.marginals(scores, np.array([count]), turns), both[:, 1] / both.sum(axis=1), atol=1e-9)


def test_training_marginals_equal_scoring_marginals():
    draw = np.random.default_rng(6)
    lengths = np.array([8, 1, 5, 8])
    scores, turns = draw.normal(0, 2, (4, 8)), draw.normal(0, 2, (2, 2))
    tags, changes = t._expected(scores, lengths, turns)
    flat = np.concatenate([scores[i, :n] for i, n in enumerate(lengths)])
    assert np.allclose(np.concatenate([tags[i, :n] for i, n in enumerate(lengths)]), t.marginals(flat, lengths, turns))
    assert np.isclose(changes.sum(), (lengths - 1).sum())


def test_spans_join_neighbours_and_count_code_points():
    text = "é bad  bad, ok bad"
    assert t.spans_of(text, np.array([0.1, 0.9, 0.8, 0.2, 0.5])) == [(2, 10), (15, 18)]
    assert t.spans_of("a b", np.array([0.0, 0.0])) == []


def corpus(seed, count):
    """Texts of mild words; the toxic ones hold some harsh ones."""
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = [draw.choice(MILD) + draw.choice(["", "s", "er"]) for _ in range(draw.randrange(20, 60))]
        toxic = int(draw.random() < 0.3)
        for _ in range(draw.randrange(3, 7) * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(HARSH) + draw.choice(["", "!", "en"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic, "t", "l", 3, 0.5))
    return rows, labels


@pytest.fixture(scope="module")
def judged(spark):
    rows, labels = corpus(1, 500)
    extra = [(1000, None), (1001, ""), (1002, " \n"), (None, "a gruk grukling"), (1003, "mill " * 20000 + "blarg grukest gruken"), (3, rows[3][1]), (3, rows[3][1])]
    odd = [(None, 1, 1, "", "", 1, 0.0), (1001, 1, None, "", "", 1, 0.0), (7, 1, 0, "", "", 1, 0.0), (7, 1, 1, "", "", 1, 0.0), (9, 1, 5, "", "", 1, 0.0)]
    documents = spark.createDataFrame([(*r, 9, "x") for r in rows + extra], "doc_id long, text string, toxic long, spans string")
    labelled = spark.createDataFrame([r for r in labels if r[0] not in (7, 9)] + odd, LABELS)
    return rows + extra, dict((i, x) for i, _, x, *_ in labels), t.judge(documents, labelled).collect(), documents, labelled


def test_held_out_texts_are_told_apart(judged):
    rows, labels, found, *_ = judged
    assert len(found) == len(rows)
    for row in found:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
        if row.doc_id in labels:
            assert row.predicted == labels[row.doc_id]


def test_odd_texts(judged):
    rows, _, found, *_ = judged
    by = {}
    for row in found:
        by.setdefault(row.doc_id, []).append(row)
    assert len({(r.score, r.n_words, r.spans) for i in (1000, 1001, 1002) for r in by[i]}) == 1 and by[1000][0].predicted == 0
    assert by[None][0].predicted == 1 and by[1003][0].spans == "100000:100020" and by[1003][0].n_words == 20003
    assert len(by[3]) == 3 and len({r.score for r in by[3]}) == 1


def test_spans_are_the_harsh_words(judged):
    rows, labels, found, *_ = judged
    texts = dict(rows)
    got = {texts[r.doc_id][slice(*map(int, s.split(":")))].split()[0].strip("!") for r in found if r.spans and r.doc_id is not None for s in r.spans.split(",")}
    assert all(word.startswith(HARSH) for word in got)


def test_only_learning_rows_matter(spark, judged):
    *_, documents, labelled = judged
    turned = labelled.withColumn("toxic", F.expr("CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END"))
    few = documents.where("doc_id < 40")
    model, other = t.learn(documents, labelled), t.learn(documents, turned)
    assert [r.score for r in t.tag(few, model).orderBy("doc_id").collect()] == [r.score for r in t.tag(few, other).orderBy("doc_id").collect()]


def test_without_labels_or_rows(spark, judged, nothing):
    *_, documents, labelled = judged
    assert {r.score for r in t.judge(documents, labelled.limit(0)).collect()} == {0.0}
    assert {r.score for r in t.judge(documents, labelled.where("toxic = 1")).collect()} == {1.0}
    assert t.judge(nothing, labelled).collect() == []


def test_copies_of_one_toxic_text_make_no_markers(spark):
    rows, _ = corpus(2, 200)
    mild = [(text, 0) for _, text in rows if not any(h in text for h in HARSH)]
    copies = [("once upon a strange quiet evening nobody sang", 1)] * 80
    sample = spark.createDataFrame(mild + copies, "text string, toxic int")
    assert t.markers(t._contexts(sample), t.Fit()) == frozenset()


def test_query_over_given_tables(spark, smoke):
    rows = queries.toxicity(spark, smoke).collect()
    assert len(rows) == spark.read.parquet(f"{smoke}/documents.parquet").count()
