"""Near-duplicate lines by an exact set-similarity join, later matches removed.

A line is the set of its words, A-Z lower-cased, kept as a table of sorted 64-bit hashes; texts are read once. Words are
ordered by rarity: a sketch of fixed size (``CELLS`` counts over all lines) gives a word's level, its hash breaks ties.
Lines with equal sets form a class, led by its earliest line (by document id, then line).

1. Prefix filter: two sets at the threshold share a word among the first few of either, so
   classes are joined on those words only.
2. Length, place and parity filters, in the join: sizes must be alike, from the places of a shared word at most so many
   words can be common, and 128 parity bits of the sets bound from below how many words differ.
3. Count filter: the prefix words that two classes share, and the words behind the prefixes, bound how many are common.
4. Verification: the pairs left get their whole sets and their Jaccard similarity.

Any earlier match removes a line, even one that is itself removed. A first round compares classes with a few
early classes of their group (common words of the prefix, two by two): that settles large groups of near copies in a few
comparisons each. The full join then pairs all classes but those that both found a match, so no match is lost.

Only DataFrame functions run here. Words count as equal when 64 bits of their hash are, classes when 128 bits are, so an id
on several rows mixes nothing up. Ids may be of any type that can be ordered.

Defined results: null and empty texts have no lines with words; lines without words are kept and match
nothing; lines at the same place (rows with the same id, line number) never remove each other,
so repeated rows fare alike; rows without id come last, ordered by the hash of their text; an empty
table gives an empty one; further columns are not read, or pass through ``without_lines``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Workspace

CELLS = 1 << 18
FILTER_BITS = 1 << 24
_LATE = 1 << 30  # added to the line numbers of rows without id

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = "[\\x20\\x09-\\x0D]+"
_RARE_SPACES = "\t\v\f\r"


@dataclass(frozen=True)
class Lines:
    """Least Jaccard similarity in percent; classes from which a group has heads, and how many it has."""

    percent: int = 80
    group: int = 8
    heads: int = 4


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _hashes(body: Column, plain: Column) -> Column:
    """Hashes of the words of a line. Plain lines have no white space but spaces, which split faster than a pattern does.

    ``lower`` changes A-Z only where a text is ASCII; other words go letter by letter.
    """

    def low(word: Column) -> Column:
        return F.when(_ascii(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))

    def parts(text: Column) -> Column:
        return F.when(plain, F.split(text, " ")).otherwise(F.split(text, _SPACES))

    ascii_words = F.transform(parts(F.lower(body)), lambda w: F.xxhash64(w))
    return F.when(_ascii(body), ascii_words).otherwise(F.transform(parts(body), lambda w: F.xxhash64(low(w))))


def _place(doc: str = "doc", line: str = "line") -> Column:
    """What orders lines: rows without id last, then document, then line."""
    return F.struct((F.col(line) >= _LATE).alias("late"), F.col(doc).alias("doc"), F.col(line).alias("line"))


def _lines(texts: DataFrame, space: Workspace) -> DataFrame:
    """doc, line (order of rows without id after all others), text_hash, line_no, words and 128 bits of lines with words."""
    plain = reduce(and_, [F.size(F.split("text", c)) == 1 for c in _RARE_SPACES])
    rows = texts.withColumn("plain", plain).select(  # once a text: what stands beside the generator runs once a line
        F.struct(F.col("key").alias("id"), F.when(F.col("key").isNull(), F.col("text_hash")).alias("hash")).alias("doc"),
        "text_hash",
        F.col("key").isNull().alias("late"),
        "plain",
        F.posexplode(F.split("text", "\n")).alias("line_no", "body"),
    )
    words = F.array_remove(F.array_distinct(_hashes(F.col("body"), F.col("plain"))), F.xxhash64(F.lit("")))
    line = F.col("line_no") + F.when(F.col("late"), _LATE).otherwise(0)
    sets = rows.select("doc", line.alias("line"), "text_hash", "line_no", F.sort_array(words).alias("words"))
    sets = sets.select("*", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"))
    return space.keep(sets, "lines", "zstd").where(F.size("words") > 0)


def _cell(word: Column) -> Column:
    return word.bitwiseAND(F.lit(CELLS - 1)).cast("int")


def _levels(lines: DataFrame, space: Workspace) -> DataFrame:
    """One row: ``CELLS`` levels, the logarithm of how often a cell's words occur, and the level of common words."""
    counts = lines.select(F.explode("words").alias("word")).groupBy(_cell(F.col("word")).alias("id")).count()
    level = lambda n: F.coalesce(F.round(512 * F.log2(n)), F.lit(0)).cast("int")
    cells = lines.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("id")).join(counts, "id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", level(F.col("count")).alias("level"))))
    common = level(F.greatest(F.lit(16), F.coalesce(F.sum("count") / CELLS, F.lit(0.0))))
    return space.keep(cells.agg(F.transform(ordered, lambda c: c["level"]).alias("levels"), common.alias("common")), "levels")


def _prefix(n: Column, percent: int) -> Column:
    """How many words the prefix of a set of n words has."""
    return n - F.ceil(percent * n / 100).cast("int") + 1


def _parity() -> list[Column]:
    """128 bits, of which each word of a set flips one: the first half by negative hashes, the second by the others."""
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))

    def half(negative: bool) -> Column:
        return F.aggregate("words", F.lit(0).cast("long"), lambda b, w: F.when((w < 0) == F.lit(negative), b.bitwiseXOR(bit(w))).otherwise(b))

    return [half(True).alias("p"), half(False).alias("q")]


def _classes(lines: DataFrame, levels: DataFrame, percent: int) -> DataFrame:
    """Different sets: name, 128 bits, first place, lines, size, parity, prefix (31 bits a word) and up to six common words of it."""
    level = lambda w: F.coalesce(F.get(F.col("levels"), _cell(w)), F.lit(0)).cast("long")
    # never null, so that Spark sorts plain longs
    code = lambda w: F.coalesce(F.shiftleft(level(w), 48).bitwiseOR(F.shiftrightunsigned(w, 16)), F.lit(0).cast("long"))
    n = F.size("words")
    coded = lines.withColumns({c: levels.select(c).scalar() for c in ("levels", "common")}).select(
        "h1", "h2", _place().alias("first"), n.alias("n"), *_parity(), "common",
        F.slice(F.sort_array(F.transform("words", code)), F.lit(1), _prefix(n, percent)).alias("prefix"),
    )
    coded = coded.select(
        "h1", "h2", "first", "n", "p", "q",
        F.transform("prefix", lambda c: c.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("prefix"),
        F.filter("prefix", lambda c: F.shiftright(c, 48) >= F.col("common")).alias("commons"),
    )
    # the three of least and of largest hash, which one copy seldom differs in from another
    coded = coded.withColumn("commons", F.sort_array(F.transform("commons", lambda c: c.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))))
    coded = coded.withColumn("commons", F.when(F.size("commons") > 6, F.concat(F.slice("commons", 1, 3), F.slice("commons", -3, 3))).otherwise(F.col("commons")))
    groups = coded.groupBy("h1", "h2").agg(
        F.min("first").alias("first"), F.count("*").alias("m"), *[F.first(c).alias(c) for c in ("n", "p", "q", "prefix", "commons")]
    )
    return groups.withColumn("name", F.monotonically_increasing_id())


def _may_match(percent: int) -> Column:
    """Whether sizes are alike and the parity bits differ in no more places than words may."""
    n_a, n_b = F.col("n_a"), F.col("n_b")
    lengths = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    # size - 2 * shared words differ, and shared * (100 + percent) >= percent * size at the threshold
    unlike = F.bit_count(F.col("p_a").bitwiseXOR(F.col("p_b"))) + F.bit_count(F.col("q_a").bitwiseXOR(F.col("q_b")))
    return lengths & ((100 + percent) * unlike <= (100 - percent) * (n_a + n_b))


def _may_share(most: Column, percent: int) -> Column:
    """Whether so many common words may reach the threshold."""
    return (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))


def _side(frame: DataFrame, side: str, keys: list[str]) -> DataFrame:
    return frame.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in frame.columns if c not in keys])


def _band(n: Column, percent: int) -> Column:
    """Sizes of one band are alike enough to be compared."""
    return n.cast("long") if percent >= 100 else F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)))


def _first_pairs(classes: DataFrame, lines: Lines) -> DataFrame:
    """A few early classes of each group (two common words, like lengths) with the others."""

    def two(i: int, j: int) -> Column:
        return F.when(F.size("commons") > j, F.xxhash64(F.get("commons", F.lit(i)), F.get("commons", F.lit(j)), F.col("band")))

    banded = classes.where(F.size("commons") > 1).withColumn("band", _band(F.col("n"), lines.percent))
    keys = F.array_compact(F.array(*[two(i, j) for i, j in ((0, 1), (0, 2), (1, 2), (3, 4), (3, 5), (4, 5))]))
    members = banded.select("name", "first", "n", "p", "q", F.explode(keys).alias("group"))
    large = members.groupBy("group").count().where(F.col("count") >= lines.group).select("group")
    members = members.join(large, "group")
    heads = members.groupBy("group", F.pmod(F.xxhash64("name"), F.lit(lines.heads)).alias("part"))
    heads = heads.agg(F.min(F.struct("first", "name", "n", "p", "q")).alias("h")).select("group", "h.*")
    pairs = _side(heads, "a", ["group"]).join(_side(members, "b", ["group"]), "group")
    return pairs.where((F.col("first_a") < F.col("first_b")) & _may_match(lines.percent)).select(*_PAIR).distinct()


_PAIR = ["name_a", "name_b", "n_a", "n_b"]


def _other_pairs(classes: DataFrame, matched: DataFrame, lines: Lines) -> DataFrame:
    """All pairs that may match, but those of classes that both found a match."""
    done = classes.join(matched.withColumn("matched", F.lit(True)), "name", "left")
    done = done.select("name", "n", "p", "q", F.coalesce("matched", F.lit(False)).alias("done"), F.posexplode("prefix").alias("place", "word"))
    n_a, n_b, place_a, place_b = (F.col(c) for c in ("n_a", "n_b", "place_a", "place_b"))
    most = F.least(place_a, place_b) + F.least(n_a - place_a, n_b - place_b)
    wanted = (F.col("name_a") < F.col("name_b")) & ~(F.col("done_a") & F.col("done_b")) & _may_match(lines.percent)
    rows = _side(done, "a", ["word"]).join(_side(done, "b", ["word"]), "word").where(wanted & _may_share(most, lines.percent))
    behind = F.greatest(n_a - _prefix(n_a, lines.percent), n_b - _prefix(n_b, lines.percent))
    return rows.groupBy(*_PAIR).count().where(_may_share(F.col("count") + behind, lines.percent)).select(*_PAIR)


def _in_filter(rows: DataFrame, wanted: DataFrame, space: Workspace) -> DataFrame:
    """Rows whose first 64 bits a bitmap of fixed size holds: a superset of the wanted ones."""
    bit = F.pmod(F.col("h1"), F.lit(FILTER_BITS))
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    parts = wanted.groupBy(F.shiftright(bit, 6).alias("id")).agg(F.bit_or(flag).alias("bits"))
    dense = rows.sparkSession.range(FILTER_BITS // 64).join(parts, "id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    maps = space.keep(dense.agg(F.transform(ordered, lambda c: c["bits"]).alias("maps")), "filter")
    marked = rows.withColumn("maps", maps.select("maps").scalar())
    held = F.getbit(F.get("maps", F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int"))
    return marked.where(held == 1).drop("maps")


def _matches(pairs: DataFrame, classes: DataFrame, rows: DataFrame, lines: Lines, space: Workspace) -> DataFrame:
    """Later classes (by name) of the pairs at the threshold."""
    named = pairs.select(F.col("name_a").alias("name")).union(pairs.select("name_b")).distinct()
    wanted = space.keep(classes.join(named, "name", "left_semi").select("name", "h1", "h2", "first"), "wanted")
    found = _in_filter(rows, wanted, space).select("h1", "h2", _place().alias("first"), "words")
    same = ["h1", "h2", "first"]  # the join's keys, so that grouping the lines of repeated rows shuffles nothing again
    sets = found.join(wanted, same).groupBy(*same).agg(F.first("name").alias("name"), F.first("words").alias("words"))
    sets = space.keep(sets.select("name", "words", "first"), "sets", "zstd")
    both = pairs.join(_side(sets.withColumnRenamed("name", "name_a"), "a", ["name_a"]), "name_a")
    both = both.join(_side(sets.withColumnRenamed("name", "name_b"), "b", ["name_b"]), "name_b")
    alike = both.where(_may_share(F.size(F.array_intersect("words_a", "words_b")), lines.percent))
    # Different lines at one place, of rows with the same id, stand before neither.
    later = F.when(F.col("first_a") < F.col("first_b"), F.col("name_b")).when(F.col("first_b") < F.col("first_a"), F.col("name_a"))
    matched = space.keep(alike.select(later.alias("name")).where("name IS NOT NULL").distinct(), "matched")
    for name in ("wanted", "filter", "sets"):
        space.drop(name)
    return matched


def removed_lines(documents: DataFrame, lines: Lines = Lines(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines that an earlier line matches: key, text_hash and line_no."""
    space = Workspace(documents.sparkSession, "line-dedup")
    body = documents[text]
    rows = _lines(documents.select(documents[key].alias("key"), F.xxhash64(body).alias("text_hash"), body.alias("text")), space)
    classes = space.keep(_classes(rows, _levels(rows, space), lines.percent), "classes", "zstd")
    first = space.keep(_first_pairs(classes, lines), "pairs")
    matched = _matches(first, classes, rows, lines, space)
    seen = first.select(F.least("name_a", "name_b").alias("name_a"), F.greatest("name_a", "name_b").alias("name_b"))
    others = space.renew(_other_pairs(classes, matched, lines).join(seen, ["name_a", "name_b"], "left_anti"), "pairs")
    classes = space.renew(classes.select("name", "h1", "h2", "first", "m"), "classes")
    matched = matched.union(_matches(others, classes, rows, lines, space)).distinct()
    flagged = classes.join(matched.withColumn("matched", F.lit(True)), "name", "left")
    flagged = flagged.where("m > 1 or matched").select("h1", "h2", "first", "matched")
    all_lines = rows.select("h1", "h2", "text_hash", "line_no", F.col("doc.id").alias("key"), _place().alias("here"))
    gone = all_lines.join(flagged, ["h1", "h2"]).where((F.col("first") < F.col("here")) | F.col("matched"))
    return space.result(gone.select("key", "text_hash", "line_no").distinct(), "removed-lines")


def summarise(documents: DataFrame, lines: Lines = Lines(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the key, n_lines, n_removed and the numbers (from 0) of the lines removed."""
    removed = removed_lines(documents, lines, key, text)
    gone = removed.groupBy(F.col("key").alias("r_key"), F.col("text_hash").alias("r_hash")).agg(
        F.array_sort(F.collect_list("line_no")).alias("removed")  # at most the lines of one text
    )
    body = documents[text]
    rows = documents.select(
        documents[key].alias("key"), F.xxhash64(body).alias("text_hash"), F.coalesce(F.size(F.split(body, "\n")), F.lit(0)).alias("n_lines")
    )
    joined = rows.join(gone, F.col("key").eqNullSafe(F.col("r_key")) & (F.col("text_hash") == F.col("r_hash")), "left")
    removed_numbers = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select(F.col("key").alias(key), "n_lines", F.size(removed_numbers).alias("n_removed"), removed_numbers.alias("removed_lines"))


def without_lines(documents: DataFrame, lines: Lines = Lines(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns, their texts without the lines removed."""
    removed = removed_lines(documents, lines, key, text)
    gone = removed.groupBy(F.col("key").alias("r_key_"), F.col("text_hash").alias("r_hash_")).agg(F.collect_list("line_no").alias("r_lines_"))
    same = documents[key].eqNullSafe(F.col("r_key_")) & (F.xxhash64(documents[text]) == F.col("r_hash_"))
    joined = documents.join(gone, same, "left")
    kept = F.filter(F.split(documents[text], "\n"), lambda _, i: ~F.array_contains("r_lines_", i))
    cleaned = F.when(F.col("r_lines_").isNull(), documents[text]).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[cleaned.alias(c) if c == text else documents[c] for c in documents.columns])
