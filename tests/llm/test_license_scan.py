from __future__ import annotations

import random
import re

from ledgerlake.llm import license_scan as s
from tests.llm.conftest import LOWER

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    tokens = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in s.PHRASES for i in range(len(tokens)) if tokens[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(tokens), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_equals_plain_scan(spark, odd):
    draw = random.Random(8)
    parts = ["CC", "by", "-", " ", "General Public", "license", "LICENSE ", "all rights reserved", "All-Rights\nReserved", "é", "x1", ". ", "\x00"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randrange(0, 25))) for _ in range(400)]
    texts += ["cc by cc by cc by", "all rights reserved all rights reserved", "cc  by", "accby", None, "", "cc by " * 20_000]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, score string").repartition(3)
    for r in s.scan(frame).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id]), texts[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    rows = s.scan(odd).collect()
    assert len(rows) == odd.count() and all(r.labels == "" and r.score == 0 for r in rows)


def test_templates_are_found_by_place(spark):
    mit = s.TEMPLATES[14][2]
    broken = mit.replace("permission is hereby granted", "permission is granted hereby")
    scattered = " filler ".join(s.TEMPLATES[7][2].split())
    texts = {
        1: "intro words " + mit.upper().replace(" ", ",\n") + " outro",
        2: broken,  # the key phrase is missing
        3: scattered,  # every word, but not at its place
        4: "Licensed under the Apache License, Version 2.0. Licensed under CC BY-SA 4.0.",
        5: "Released under the MIT License. " * 3000,
        6: None,
        7: mit.replace("software", "hardware"),  # some words differ
    }
    frame = spark.createDataFrame([*texts.items(), (1, texts[1]), (None, texts[4])], "doc_id long, text string")
    got = sorted([(r.doc_id, r.labels) for r in s.scan(frame).collect()], key=repr)
    wanted = [(1, "mit"), (1, "mit"), (2, ""), (3, ""), (4, "apache-2.0,cc-by,cc-by-sa"), (5, "mit"), (6, ""), (7, "mit"), (None, "apache-2.0,cc-by,cc-by-sa")]
    assert got == sorted(wanted, key=repr)
    scores = {r.doc_id: r.score for r in s.scan(frame).collect()}
    assert scores[1] == 1.0 and 0.7 <= scores[7] < 1.0 and scores[3] == 0.0


def test_no_licence_crowds_out_another(spark):
    notices = [notice for _, _, notice in s.TEMPLATES]
    some = "Released under the MIT License. Licensed under the Apache License, Version 2.0. All rights reserved. " + notices[6] + ". " + notices[9]
    frame = spark.createDataFrame([(1, ".\nfiller ".join(notices)), (2, some)], "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in s.scan(frame).collect()}
    assert got[1] == {label for label, _, _ in s.TEMPLATES}
    assert {"mit", "apache-2.0", "cc-by-nc", "gpl", "reserved"} <= got[2]


def test_empty_table(nothing):
    assert s.scan(nothing).collect() == []
