from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerlake.llm import mixing as m

GOOD = "river mill keeper barges rain town bridge children evening supper harvest orchard".split()
BAD = "junk filler spam dross".split()


def make(draw, domain):
    poor, toxic = domain in (0, 1), domain in (1, 3)
    tokens = [draw.choice(GOOD) + ("$$$" if poor and draw.random() < 0.5 else "") for _ in range(draw.randrange(30, 90))]
    if toxic:
        for _ in range(4):
            tokens.insert(draw.randrange(len(tokens)), draw.choice(BAD))
    return " ".join(tokens)


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(4)
    domains = draw.choices([0, 1, 2, 3], [15, 5, 65, 15], k=600)
    rows = [(i, make(draw, d), i % 7, 0.25) for i, d in enumerate(domains)]
    labels = [(i, d // 2, d % 2) for i, d in enumerate(domains) if i % 3]
    documents = spark.createDataFrame(rows, "doc_id long, text string, key int, rate double").repartition(3)
    return documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), domains


def test_held_out_rows_are_told_apart(corpus):
    documents, labels, domains = corpus
    _, scored = m.fit_mixture(documents, labels)
    held_out = [r for r in scored.collect() if r.doc_id % 3 == 0]
    right = sum(int(np.argmax(r.posterior)) == domains[r.doc_id] for r in held_out)
    assert right >= 0.9 * len(held_out)
    assert all(abs(sum(r.posterior) - 1) < 1e-9 for r in held_out)


def test_totals_match_targets_and_plain_descent(corpus):
    documents, labels, _ = corpus
    weights = {"poor": 0.1, "poor_toxic": 0.02, "good": 0.8, "good_toxic": 0.08}
    fitted, scored = m.fit_mixture(documents, labels, weights)
    rows = m.with_rates(scored, fitted).collect()
    tokens, p = np.array([r.n_tokens for r in rows], float), np.array([r.posterior for r in rows])
    rates = np.array([r.rate for r in rows])
    assert (rates >= 0).all()
    assert np.allclose((rates * tokens) @ p, fitted.totals)
    assert np.abs(fitted.totals - fitted.targets).max() <= 1e-3 * fitted.targets.sum()
    # the same steps with all documents in one array
    square = (p * tokens[:, None]).T @ p
    scale = np.diag(square)
    step = 1 / np.linalg.eigvalsh(square / np.sqrt(np.outer(scale, scale))).max()
    plain = np.full(len(rows), fitted.start)
    for _ in range(len(fitted.moves)):
        plain = np.maximum(0, plain - p @ (step * ((plain * tokens) @ p - fitted.targets) / scale))
    assert np.allclose(plain, rates)


def test_resampling_follows_rates(corpus):
    documents, labels, _ = corpus
    fitted, scored = m.fit_mixture(documents, labels, budget=50_000.0, fit=m.Fit(repeats=9.0))
    rates = {r.doc_id: r.rate for r in m.with_rates(scored, fitted).collect()}
    drawn = m.resample(documents, fitted)
    assert drawn.columns == documents.columns
    copies: dict[int, int] = {}
    for r in drawn.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert all(np.floor(rate) <= copies.get(k, 0) <= np.floor(rate) + 1 for k, rate in rates.items())
    assert abs(sum(copies.values()) - sum(rates.values())) < 0.1 * sum(rates.values())
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, m.resample(documents, fitted).collect()))


def test_scarce_domains_are_not_repeated_by_default(corpus):
    documents, labels, _ = corpus
    fitted, scored = m.fit_mixture(documents, labels, {"poor": 0.5, "good": 0.5})
    present = sum(r.n_tokens * r.posterior[0] for r in scored.collect())
    assert fitted.targets[0] <= present + 1e-6


def test_odd_rows_and_empty_tables(spark, odd, nothing, corpus):
    _, labels, _ = corpus
    fitted, scored = m.fit_mixture(odd, labels)
    rows = m.with_rates(scored, fitted).collect()
    assert len(rows) == odd.count() and all(r.n_tokens == 0 for r in rows if r.doc_id in (4, 5, 6))
    assert m.resample(odd, fitted).columns == odd.columns
    none = labels.limit(0)
    _, even = m.fit_mixture(odd, none)
    assert all(np.allclose(r.posterior, 0.25) for r in even.collect())
    fitted, scored = m.fit_mixture(nothing, labels)
    assert m.with_rates(scored, fitted).collect() == [] and m.resample(nothing, fitted).collect() == []
    nulls = spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 1, None), (1, 7, 0)], labels.schema)
    _, even = m.fit_mixture(odd, nulls)
    assert all(np.allclose(r.posterior, 0.25) for r in even.collect())


def test_rare_toxic_words_of_small_languages_are_held_out_recalled(spark):
    """Each toxic word of a small language stands in fewer than 2 percent of the labelled texts."""
    draw = random.Random(11)
    rows = []
    for language, count in (("en", 900), ("de", 120), ("fr", 120), ("es", 120)):
        plain = [f"{language}word{i}" for i in range(300)]
        bad = [f"{language}bad{i}" for i in range(8)]
        for _ in range(count):
            toxic = draw.random() < 0.3
            tokens = [draw.choice(plain) for _ in range(draw.randrange(30, 90))] + (draw.sample(bad, 3) if toxic else [])
            draw.shuffle(tokens)
            rows.append((len(rows), " ".join(tokens), language, toxic))
    documents = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, int(x)) for i, _, _, x in rows if i % 3], "doc_id long, quality int, toxic int")
    _, scored = m.fit_mixture(documents, labels)
    judged = {r.doc_id: r.posterior[1] + r.posterior[3] >= 0.5 for r in scored.collect() if r.doc_id % 3 == 0}
    for language in ("en", "de", "fr", "es"):
        toxic = [judged[i] for i, _, own, x in rows if i in judged and own == language and x]
        clean = [judged[i] for i, _, own, x in rows if i in judged and own == language and not x]
        assert sum(toxic) >= 0.8 * len(toxic), (language, sum(toxic), len(toxic))
        assert sum(clean) <= 0.1 * len(clean), (language, sum(clean), len(clean))
