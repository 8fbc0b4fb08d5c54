from __future__ import annotations

import random

import pytest

from ledgerlake.llm import line_dedup as d
from tests.llm.conftest import SCHEMA, document, low_words


def plain_removed(rows, percent):
    """Per row the lines that a line strictly before them matches, by comparing all pairs."""
    lines = []
    for n, (name, text) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            if tokens := frozenset(low_words(line)):
                lines.append(((name is None, name if name is not None else text, i), n, i, tokens))
    removed = [set() for _ in rows]
    for place, n, i, tokens in lines:
        for other, _, _, more in lines:
            if other < place and 100 * len(tokens & more) >= percent * len(tokens | more):
                removed[n].add(i)
                break
    return removed


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    bases = [[f"v{draw.randrange(60)}" for _ in range(draw.choice([1, 2, 5, 12, 40]))] for _ in range(30)]

    def line():
        tokens = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 3])):
            tokens[draw.randrange(len(tokens))] = f"w{draw.randrange(500)}"
        draw.shuffle(tokens)
        return draw.choice(["", " ", "\t"]).join(["", " ".join(tokens)]).upper() if draw.random() < 0.2 else " ".join(tokens)

    made = [(draw.randrange(10_000), "\n".join(line() if draw.random() < 0.9 else " " for _ in range(draw.randrange(1, 12)))) for _ in range(60)]
    ids = [k for k, _ in made]
    made = [r for n, r in enumerate(made) if r[0] not in ids[:n]]
    return [*made, (20_001, None), (20_002, ""), (20_003, "\n\n"), (20_004, "v1 " * 5000 + "\nv1")]


@pytest.mark.parametrize("percent", [80, 60, 100])
def test_equals_all_pairs(spark, rows, percent):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: set(r.removed_lines) for r in d.summarise(frame, d.Lines(percent)).collect()}
    wanted = dict(zip([k for k, _ in rows], plain_removed(rows, percent)))
    assert got == wanted and any(wanted.values())


def test_odd_rows_and_texts(spark, odd, nothing):
    found = d.summarise(odd).collect()
    assert len(found) == odd.count()
    # rows 1, 2 and 2 are copies: the first line stays once for id 1, and both rows of id 2 lose it
    assert sorted(r.n_removed for r in found if r.doc_id == 1) == [0]
    assert sorted(r.n_removed for r in found if r.doc_id == 2) == [0, 1, 1]
    assert all(r.n_removed == 0 for r in found if r.doc_id in (4, 5, 6))
    cleaned = d.without_lines(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == odd.count()
    texts = {r.doc_id: r.text for r in cleaned.collect() if r.doc_id in (11, 12)}
    assert texts[12] == "repeated line of some words here" and texts[11] == "a\n\nb"
    assert d.summarise(nothing).collect() == [] and d.without_lines(nothing).collect() == []


def test_rows_without_id_come_last(spark):
    rows = [document(None, "alpha beta gamma delta"), document(5, "alpha beta gamma delta"), document(None, "alpha beta gamma delta epsilon")]
    got = sorted([(r.doc_id, r.n_removed) for r in d.summarise(spark.createDataFrame(rows, SCHEMA)).collect()], key=repr)
    assert got == sorted([(5, 0), (None, 1), (None, 1)], key=repr)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_one_id_on_two_texts_mixes_nothing_up(spark, kind):
    one, two = " ".join(f"a{i}" for i in range(10)), " ".join(f"a{i}" for i in range(9))
    other = " ".join(f"z{i}" for i in range(10))
    rows = [(1, one), (5, two), (5, other), (7, other + " z11"), (7, "quite another line"), (7, "quite another line here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(f"CAST(doc_id AS {kind}) AS doc_id", "text")
    got = sorted((int(r.doc_id), r.n_removed) for r in d.summarise(frame).collect())
    assert got == [(1, 0), (5, 0), (5, 1), (7, 0), (7, 0), (7, 1)]
    assert sorted(r.text for r in d.without_lines(frame).collect() if r.text) == sorted([one, other, "quite another line", "quite another line here"])


def test_long_unlike_lines_with_a_few_rare_words_in_common_are_no_pairs(spark, monkeypatch):
    draw, seen, matches = random.Random(4), [], d._matches
    pool = [f"p{i}" for i in range(1000)]
    texts = [" ".join([*(f"s{n // 2}x{i}" for i in range(5)), *draw.sample(pool, 145)]) for n in range(30)]
    monkeypatch.setattr(d, "_matches", lambda pairs, *more: (seen.append(pairs.count()), matches(pairs, *more))[1])
    found = d.summarise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(found) == 30 and all(r.n_removed == 0 for r in found) and sum(seen) == 0
