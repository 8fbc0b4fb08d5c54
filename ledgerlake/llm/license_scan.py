"""Licences of texts by a positional index of rare words.

Texts are lower-cased (A-Z) and cut into words of digits, a-z and code points above ASCII. Templates are
short licence notices; their words, but for the commonest of the language, are the licence
words, and a posting says where a word stands in a template.

1. One pass takes from every text its figures, the places of licence words and the key phrases that
   it holds. What is kept is small; texts are not shuffled.
2. The document frequency of every licence word is counted over all texts.
3. For every template each text looks up those of its words that it holds, of highest IDF first,
   so that one licence never crowds out another. Postings are intersected by relative
   position: a template lies at one offset where at least two of those rare words agree. Its score
   is the share of its licence words that stand at their place from there, and it is accepted
   from ``least_score`` on when the text holds the template's key phrase.

Rows of one text are grouped by id and text, so equal rows get equal results. Only the table
of postings and the IDF of licence words are broadcast; both follow from the templates below.

Defined results: a null text is an empty one: no words, no places, no labels, score 0; ids may be null
or repeated; an empty table gives an empty one; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise

# Phrases and labels of the base scan.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Label, key phrase and words of each notice.
TEMPLATES = (
    ("agpl", "affero general public license", "licensed under the terms of the gnu affero general public license"),
    ("apache-2.0", "apache license", "licensed under the apache license version 2 0"),
    ("apache-2.0", "apache license", "you may not use this file except in compliance with the license apache license"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met"),
    ("cc-by", "cc by", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc0", "cc0 1 0", "dedicated to the public domain under cc0 1 0 universal"),
    ("gpl", "general public license", "licensed under the gnu general public license version 3"),
    ("gpl", "general public license",
     "redistribute it and or modify it under the terms of the gnu general public license as published by the free "
     "software foundation"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "lesser general public license", "under the terms of the gnu lesser general public license"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files"),
    ("mpl-2.0", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved", "all rights reserved"),
    ("unlicense", "released into the public domain", "free and unencumbered software released into the public domain"),
)

COMMON = frozenset(
    "a all and any are as at be by except following for free in into is it may not of on or provided that the this to "
    "under use used v with without you 0 1 2 3 4".split()
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Lookup:
    """Rare words looked up per text and template, rare words that must agree and least score."""

    rare: int = 8
    agree: int = 2
    least_score: float = 0.7


def _postings() -> list[tuple[int, str, str, str, int, int]]:
    """Template, label, key phrase, word, place and number of licence words."""
    rows = []
    for number, (label, phrase, notice) in enumerate(TEMPLATES):
        placed = [(w, i) for i, w in enumerate(notice.split()) if w not in COMMON]
        rows += [(number, label, phrase, w, i, len(placed)) for w, i in placed]
    return rows


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _words_in(text: Column) -> Column:
    """Words of a text in which every word has a space of its own on either side."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("long")


def figures(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, text_hash, n_words, base figures, places of licence words, key phrases held."""
    vocabulary = sorted({row[3] for row in _postings()})
    phrases = sorted({row[2] for row in _postings()})
    body = documents[text]
    rows = documents.select(
        documents[key].alias("key"),
        F.xxhash64(body).alias("text_hash"),
        F.trim(F.regexp_replace(F.translate(F.coalesce(body, F.lit("")), _UPPER, _LOWER), _OTHER, " ")).alias("plain"),
    )
    words = F.when(F.col("plain") == "", F.array().cast("array<string>")).otherwise(F.split("plain", " "))
    rows = rows.withColumn("words", words)
    rows = rows.select(
        "key",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        "words",
        # " one  two  three ": phrases next to each other share no space
        F.when(
            F.arrays_overlap("words", _array(vocabulary)) | F.array_contains("words", "cc"),
            F.concat(F.lit(" "), F.replace("plain", F.lit(" "), F.lit("  ")), F.lit(" ")),
        ).alias("wide"),
    )
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES:
        needle = F.lit(" " + phrase.replace(" ", "  ") + " ")
        width = len(phrase) + 2 + phrase.count(" ")
        holds = F.contains("wide", needle)
        count = F.when(holds, ((F.length("wide") - F.length(F.replace("wide", needle, F.lit("")))) / width).cast("long"))
        first = F.when(holds, _words_in(F.substr("wide", F.lit(1), F.instr("wide", needle) - 1)))
        tail = F.substring_index("wide", " " + phrase.replace(" ", "  ") + " ", -1)
        last = F.when(holds, F.col("n_words") - _words_in(tail) - len(phrase.split()))
        counts.append(F.coalesce(count, F.lit(0).cast("long")))
        firsts.append(first)
        lasts.append(last)
        labels.append(F.when(holds, F.lit(label)))
    hits = F.filter(
        F.transform("words", lambda w, i: F.named_struct(F.lit("word"), w, F.lit("place"), i)),
        lambda x: F.array_contains(_array(vocabulary), x["word"]),
    )
    return rows.select(
        "key",
        "text_hash",
        "n_words",
        (counts[0] + counts[1] + counts[2]).alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base_labels"),
        F.when(F.col("wide").isNotNull(), hits).alias("hits"),
        F.when(
            F.col("wide").isNotNull(),
            F.filter(_array(phrases), lambda p: F.contains(F.col("wide"), F.concat(F.lit(" "), F.replace(p, F.lit(" "), F.lit("  ")), F.lit(" ")))),
        ).alias("phrases"),
    )


def found_templates(rows: DataFrame, lookup: Lookup = Lookup()) -> DataFrame:
    """Accepted templates per text: key, text_hash, label, score."""
    spark = rows.sparkSession
    holders = rows.where(F.size("hits") > 0).select("key", "text_hash", "hits", "phrases")
    seen = holders.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
    frequency = seen.groupBy("word").agg(F.count("*").alias("df"))
    idf = {r.word: r.df for r in frequency.collect()}  # at most the licence words
    if not idf:
        return rows.select("key", "text_hash", F.lit("").alias("label"), F.lit(0.0).alias("score")).limit(0)
    # The words of each template by IDF, and the place of each among them.
    ranked = [sorted({w for w in notice.split() if w in idf and w not in COMMON}, key=lambda w: (idf[w], w)) for _, _, notice in TEMPLATES]
    table = [(*row, ranked[row[0]].index(row[3])) for row in _postings() if row[3] in idf]
    postings = F.broadcast(  # fixed size: the templates above
        spark.createDataFrame(table, "template int, label string, phrase string, word string, at int, size int, rank int")
    )
    held = F.array_distinct(F.transform("hits", lambda h: h["word"]))

    def last_rank(number: int) -> Column:
        """Rank of the last word that the text looks up for a template."""
        words = _array(ranked[number]) if ranked[number] else F.array().cast("array<string>")
        own = F.slice(F.filter(words, lambda w: F.array_contains("held", w)), 1, lookup.rare)
        place = F.array_position(words, F.element_at(own, -1)).cast("int") - 1
        return F.when(F.array_contains("phrases", TEMPLATES[number][1]) & (F.size(own) > 0), place)

    # Written, so that the rare words are found once per text and not once per place.
    looked_up = holders.withColumn("held", held)
    looked_up = looked_up.select("key", "text_hash", "phrases", F.array(*map(last_rank, range(len(TEMPLATES)))).alias("lasts"), "hits")
    looked_up = materialise(looked_up, "licence-lookups")
    placed = looked_up.select("key", "text_hash", "phrases", "lasts", F.explode("hits").alias("hit"))
    placed = placed.select("key", "text_hash", "phrases", "lasts", F.col("hit.word").alias("word"), F.col("hit.place").alias("place"))
    lying = placed.join(postings, "word").where(F.array_contains("phrases", F.col("phrase")))
    lying = lying.withColumn("is_rare", F.col("rank") <= F.get("lasts", F.col("template")))
    lying = lying.select("key", "text_hash", "template", "label", "size", (F.col("place") - F.col("at")).alias("offset"), "at", "is_rare")
    # Twice the same place comes from repeated rows only; places of one template are few.
    agreed = lying.groupBy("key", "text_hash", "template", "label", "size", "offset", "at").agg(F.max("is_rare").alias("is_rare"))
    agreed = agreed.groupBy("key", "text_hash", "template", "label", "size", "offset").agg(
        F.count("*").alias("n"), F.count_if("is_rare").alias("n_rare")
    )
    score = F.col("n") / F.col("size")
    accepted = agreed.where((F.col("n_rare") >= F.least(F.lit(lookup.agree), F.col("size"))) & (score >= lookup.least_score))
    return accepted.groupBy("key", "text_hash", "label").agg(F.max(score).alias("score"))


def scan(documents: DataFrame, lookup: Lookup = Lookup(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_base, first_word, last_word, base_labels, labels and score."""
    rows = materialise(figures(documents, key, text), "licence-figures")
    found = found_templates(rows, lookup)
    found = found.groupBy(F.col("key").alias("f_key"), F.col("text_hash").alias("f_text_hash")).agg(
        F.collect_set("label").alias("found"),  # at most the labels of the templates
        F.max("score").alias("score"),
    )
    joined = rows.join(found, F.col("text_hash").eqNullSafe(F.col("f_text_hash")) & F.col("key").eqNullSafe(F.col("f_key")), "left")
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("found", F.array().cast("array<string>")))))
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
