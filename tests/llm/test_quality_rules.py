from __future__ import annotations

import random

from ledgerlake.llm import quality_rules as q
from tests.llm.conftest import PROSE, words


def repeated(tokens, size):
    """Words in windows that occur twice, by comparing windows as tuples."""
    windows = [tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + size))
    return len(hit)


def test_repeated_words_equal_brute_force():
    draw = random.Random(3)
    for _ in range(300):
        tokens = [str(draw.randrange(draw.choice([1, 2, 5, 40]))).encode() for _ in range(draw.randrange(0, 60))]
        if draw.random() < 0.5:
            tokens += tokens[: draw.randrange(0, 20)]
        size = draw.choice([1, 2, 3, 8])
        assert q.repeated_words(tokens, size) == repeated(tokens, size)


def test_figures_equal_brute_force(spark, odd):
    rows = q.assess(odd).collect()
    assert len(rows) == odd.count()
    got = sorted([tuple(r)[:7] for r in rows], key=repr)
    wanted = []
    for row in odd.collect():
        text, tokens = row.text or "", words(row.text)
        seen, again = set(), 0
        for line in text.split("\n"):
            if words(line):
                again += line in seen
                seen.add(line)
        window = repeated(tokens, 8) if len(tokens) < 300 else None
        wanted.append((row.doc_id, len(tokens), sum(map(len, tokens)), sum(c in "#*$%&|<>" for c in text), again, window))
    for g, w in zip(got, sorted(wanted, key=repr)):
        assert g[:5] == w[:5] and (w[5] is None or g[5] == w[5])
        assert g[6] == (g[1] < 20 or 100 * g[5] > 30 * g[1])


def test_lines_are_judged_first(spark):
    junk = "\n".join(["BUY!!! NOW!!! ###", "Home | News | Sport | Contact", "All rights reserved. Privacy policy."])
    mostly_junk = "some words stay here\n" + "\n".join(["a | b | c | d | e | f | g | h | i"] * 4)
    frame = spark.createDataFrame(
        [(1, PROSE + "\n" + junk, "en", 7), (2, mostly_junk, "en", 7), (3, PROSE, None, None)],
        "doc_id long, text string, kept string, n_chars long",
    )
    cleaned = {r.doc_id: r for r in q.clean(frame).collect()}
    assert set(cleaned) == {1, 3}
    assert cleaned[1].text == PROSE and cleaned[1].n_chars == len(PROSE) and cleaned[1].kept == "en"
    assert cleaned[3].kept is None


def test_empty_table(nothing):
    assert q.assess(nothing).collect() == [] and q.clean(nothing).collect() == []
    assert q.clean(nothing).columns == nothing.columns
