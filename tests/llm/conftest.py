from __future__ import annotations

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}

PROSE = (
    "the river ran slowly past the old mill and the keeper counted barges while rain fell on the quiet town beyond "
    "the bridge where children once played until the evening bell called them home again for supper and sleep"
)
# Columns whose names operators use within themselves.
SCHEMA = "doc_id long, text string, key string, n long, class long, text_hash long, rate double, kept boolean, label string"


def document(doc_id, text):
    return (doc_id, text, "k", 1, 2, 3, 0.5, True, "x")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls anywhere, empty and blank texts, a very long one, repeated rows and clashing names."""
    near = PROSE.replace("barges", "ships")
    texts = [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, near), (4, None), (5, ""), (6, " \n\t"), (None, PROSE + " tail"), (None, None),
        (7, "one two"), (8, "one two"), (9, "word " * 5000 + "\n" + PROSE), (10, "é" * 30 + " ü\n" + PROSE[::-1]), (11, "a\n\nb\na"),
        (12, "\n".join(["repeated line of some words here"] * 6)), (2, "another text under a used id " + PROSE[40:]),
    ]
    rows = [document(*t) for t in texts] + [(13, PROSE.upper(), None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text) if text else []


def low_words(text):
    return WORD.findall(text.translate(LOWER)) if text else []
