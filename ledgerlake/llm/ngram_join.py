"""Jaccard self-join of documents on word n-grams, cut vertically into fragments.

Every text becomes the set of its distinct n-grams, each a 64-bit hash. All n-grams get one global
order, rare ones first, from a sketch of fixed size that counts them over the whole corpus.
The join then works on classes of equal sets, of which copies are members:

1. Candidates. Two sets that reach the threshold share an n-gram among the first few of either
   (prefix filter); pairs are dropped at once by length, by the places of the n-gram and by 128
   parity bits, to which each n-gram of a set adds one. Longer signatures, two bits per n-gram, are then
   compared: what differs in them bounds from below how many n-grams differ.
2. Verification. The global order is cut into fragments of about equal weight. The sets of
   candidates are cut at the same pivots, overlaps are counted per pair and fragment, and
   summed per pair. The sum is the exact size of the intersection.
3. Rounds. First, each n-gram's first class is compared with the others of its list, which
   joins large groups of near copies in as many comparisons as they have classes. Next, each
   list draws some classes that are compared with those of other components. Afterwards
   only pairs of classes that are not yet connected and were not compared are left. So every
   candidate pair is either compared or known to be connected, and no link is lost.

Texts are read three times rather than shuffled as sets: a set holds more bytes than its text.
What is broadcast is the sketch (``SKETCH_ROWS * SKETCH_WIDTH`` counts), whatever the input.

Defined results: a null or empty text has an empty set and is linked with nothing; a text with fewer
words than an n-gram has its whole sequence as one; repeated rows are copies of each other; the
component of a class is the least id among all rows of its component, null if none has one;
an empty table gives an empty one; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    WordHashes,
    Workspace,
    bounded_batches,
    hash_filter,
    materialise,
    mix,
    where_in_filter,
    window_hashes,
    without_rows,
)
from ledgerlake.llm.components import components

SKETCH_ROWS = 2
SKETCH_WIDTH = 1 << 16
LEVEL_BITS = 16


@dataclass(frozen=True)
class Join:
    """Words per n-gram, least Jaccard in percent, number of fragments, rounds of drawn heads, heads of a list in one."""

    size: int = 5
    percent: int = 80
    fragments: int = 8
    draws: int = 2
    heads: int = 32


def ngram_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text, A-Z lower-cased."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    values = hashes.of(words)
    if len(words) < size:  # one n-gram of another length: kept apart from those of full length
        return mix(window_hashes(values, len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(values, size))


def _places(grams: np.ndarray, row: int) -> np.ndarray:
    return (grams >> np.uint64(16 * row + 8)).astype(np.int64) & (SKETCH_WIDTH - 1)


@dataclass(frozen=True)
class Order:
    """The global order: how often an n-gram occurs at most, then its hash.

    ``level`` holds, per sketch cell, the logarithm of its count on 15 bits, so keys are
    nonnegative as longs.
    """

    level: np.ndarray
    pivots: np.ndarray

    def codes(self, grams: np.ndarray) -> np.ndarray:
        """Sort keys: the lower level over the sketch rows, then the upper bits of the hash."""
        level = self.level[0][_places(grams, 0)]
        for row in range(1, SKETCH_ROWS):
            level = np.minimum(level, self.level[row][_places(grams, row)])
        return (level.astype(np.uint64) << np.uint64(64 - LEVEL_BITS)) | (grams >> np.uint64(LEVEL_BITS))

    def fragments(self, grams: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.pivots, self.codes(grams), side="right")


def global_order(texts: DataFrame, join: Join) -> Order:
    """Count all n-grams in a sketch of fixed size; place pivots so that fragments weigh alike."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((SKETCH_ROWS, SKETCH_WIDTH), dtype=np.int64)
        hashes = WordHashes()
        for batch in batches:
            sets = [ngram_set(t, join.size, hashes) for t in batch.column(0).to_pylist()]
            grams = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
            for row in range(SKETCH_ROWS):
                cells[row] += np.bincount(_places(grams, row), minlength=SKETCH_WIDTH)
        flat = cells.ravel()
        used = np.flatnonzero(flat)
        for at in range(0, len(used), 65536):
            part = used[at : at + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(flat[part], pa.int64())], names=["cell", "n"])

    summed = texts.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = summed.toArrow()  # at most SKETCH_ROWS * SKETCH_WIDTH rows
    cells = np.zeros(SKETCH_ROWS * SKETCH_WIDTH, dtype=np.int64)
    cells[table["cell"].to_numpy()] = table["n"].to_numpy()
    level = np.rint(512 * np.log2(np.maximum(cells, 1))).astype(np.uint16).reshape(SKETCH_ROWS, SKETCH_WIDTH)
    # Weight per level as the first sketch row has it; within a level hashes are spread evenly.
    weights = np.bincount(level[0], weights=cells[:SKETCH_WIDTH], minlength=1 << LEVEL_BITS)
    upto = np.concatenate([[0.0], np.cumsum(weights)])
    pivots = []
    for k in range(1, join.fragments):
        goal = upto[-1] * k / join.fragments
        at = min(int(np.searchsorted(upto, goal, side="right")) - 1, (1 << LEVEL_BITS) - 1)
        share = (goal - upto[at]) / weights[at] if weights[at] else 0.0
        pivots.append((at << (64 - LEVEL_BITS)) + int(min(max(share, 0.0), 1.0) * ((1 << (64 - LEVEL_BITS)) - 1)))
    return Order(level, np.array(pivots, dtype=np.uint64))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _identity(grams: np.ndarray) -> tuple[int, int]:
    """A 128-bit identity of a set, as two signed longs."""
    whole = xxhash.xxh3_128_digest(grams.tobytes())
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def _signature(grams: np.ndarray) -> np.ndarray:
    """At least two bits per n-gram, each n-gram flipping one: two signatures differ in no more bits than their sets in n-grams."""
    bits = 128
    while bits < 2 * len(grams):
        bits *= 2
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _folded(rest: int) -> Column:
    """The even or the odd words of the signature as one: parity bits by the place modulo 128."""
    words = F.filter("signature", lambda _, i: i % 2 == rest)
    return F.aggregate(words, F.lit(0).cast("long"), lambda bits, word: bits.bitwiseXOR(word))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    """Arrays of longs as one column."""
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts) if parts else [], pa.int64())
    )


def describe(texts: DataFrame, order: Order, join: Join) -> DataFrame:
    """Per row: key, text hash, set size, class (two longs, null if empty), prefix codes and signature."""
    kind = texts.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, first, second, prefixes, signatures = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                grams = ngram_set(text, join.size, hashes)
                n = len(grams)
                sizes.append(n)
                a, b = _identity(grams) if n else (None, None)
                first.append(a)
                second.append(b)
                length = n - -(-join.percent * n // 100) + 1 if n else 0
                codes = order.codes(grams)
                if 0 < length < n:
                    codes = np.partition(codes, length - 1)[:length]
                prefixes.append(_signed(np.sort(codes)))
                signatures.append(_signature(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()), _lists(prefixes), _lists(signatures)],
                names=["key", "text_hash", "n", "class", "class_rest", "prefix", "signature"],
            )

    return texts.select("key", "text_hash", "text").mapInArrow(
        run, f"key {kind}, text_hash long, n long, class long, class_rest long, prefix array<long>, signature array<long>"
    )


def segments(texts: DataFrame, order: Order, join: Join) -> DataFrame:
    """The n-grams of each wanted class per fragment: class, fragment, grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            wanted, texts_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids, numbers, parts = [], [], []
            for name, text in zip(wanted, texts_):
                grams = ngram_set(text, join.size, hashes)
                if not len(grams) or _identity(grams)[0] != name:
                    continue
                places = order.fragments(grams)
                for f in np.unique(places):
                    ids.append(name)
                    numbers.append(int(f))
                    parts.append(_signed(grams[places == f]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), _lists(parts)], names=["class", "fragment", "grams"]
            )

    return texts.select("class", "text").mapInArrow(run, "class long, fragment int, grams array<long>")


def _alike(unlike: Column, size: Column, percent: int) -> Column:
    """Whether two sets of so many n-grams together may reach the threshold if so many, at least, are in one only."""
    # size - 2 * shared n-grams differ, and shared * (100 + percent) >= percent * size at the threshold
    return (100 + percent) * unlike <= (100 - percent) * size


def _may_reach(percent: int, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Length, signature and positional filter for an n-gram of two sets, at ``place`` (from 0) in either.

    No more is shared than stands from there on. Of the set whose prefix ends first, no more
    than ``most``: what its prefix alone holds would have to stand in the other prefix.
    """
    lengths = 100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n"))
    unlike = F.bit_count(a("even").bitwiseXOR(b("even"))) + F.bit_count(a("odd").bitwiseXOR(b("odd")))
    alone = F.when(a("last") <= b("last"), a("most")).otherwise(b("most"))
    most = F.least(a("n") - a("place"), b("n") - b("place"), alone)
    return lengths & _alike(unlike, a("n") + b("n"), percent) & ((100 + percent) * most >= percent * (a("n") + b("n")))


def _postings(classes: DataFrame, space: Workspace) -> DataFrame:
    """Places of the prefix n-grams that several prefixes hold: class, n, most, last, place, code, even, odd.

    ``most`` is the size of the set without the n-grams that only its own prefix holds, ``last``
    the end of its prefix, ``even`` and ``odd`` the signature folded to two words.
    """
    ends = [F.size("prefix").alias("length"), F.element_at("prefix", -1).alias("last")]
    placed = classes.select("class", "n", *ends, F.posexplode("prefix").alias("place", "code"))
    shared = placed.groupBy("code").agg(F.count("*").alias("m")).where("m > 1").select("code")
    placed = space.keep(placed.join(shared, "code", "left_semi"), "placed")
    most = placed.groupBy("class").agg((F.first("n") - F.first("length") + F.count("*")).alias("most"))
    most = most.join(classes.select("class", "even", "odd"), "class")
    postings = space.keep(placed.drop("length").join(most, "class"), "postings")
    space.drop("placed")
    return postings


_POSTING = ("class", "n", "place", "most", "last", "even", "odd")


def _band(n: Column, percent: int) -> Column:
    """Sizes of one band are alike enough to be compared."""
    return n.cast("long") if percent >= 100 else F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)))


def _first_round(postings: DataFrame, percent: int) -> DataFrame:
    """The first class of every list (of one n-gram and like lengths) with each other class."""
    banded = postings.withColumn("band", _band(F.col("n"), percent))
    heads = banded.groupBy("code", "band").agg(F.min(F.struct(*_POSTING)).alias("head"))
    pairs = banded.join(heads, ["code", "band"]).where(F.col("class") != F.col("head.class"))
    pairs = pairs.where(_may_reach(percent, F.col, lambda c: F.col(f"head.{c}")))
    return pairs.select(F.col("head.class").alias("a"), F.col("class").alias("b"), F.col("head.n").alias("n_a"), F.col("n").alias("n_b")).distinct()


def _mixed_lists(space: Workspace, postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings with the label of their class and the length of their list, of lists that hold more than one component."""
    labelled = postings.drop("label", "m").join(labels.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "class"))
    mixed = labelled.groupBy("code").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("m"))
    return space.renew(labelled.join(mixed.where("low != high").select("code", "m"), "code"), "mixed-lists")


def _drawn_heads(lists: DataFrame, join: Join, number: int) -> DataFrame:
    """Some classes drawn from every list with each class of another component in it.

    One is drawn from a list of up to ``heads`` classes, about ``heads`` more from a longer one. Lists draw for
    themselves, so a class meets many others of a large component at once and is likely to be linked with one of them.
    """
    percent, draw, head = join.percent, F.xxhash64("class", "code", F.lit(number)), [*_POSTING, "label"]
    one = lists.groupBy("code").agg(F.min(F.struct(draw.alias("draw"), *head)).alias("head"))
    more = lists.where((F.col("m") > join.heads) & (F.pmod(draw, F.col("m")) < join.heads))
    heads = one.select("code", F.struct(*[F.col(f"head.{c}").alias(c) for c in head]).alias("head"))
    heads = heads.union(more.select("code", F.struct(*head).alias("head")))
    pairs = lists.join(heads, "code").where(F.col("label") != F.col("head.label"))
    pairs = pairs.where(_may_reach(percent, F.col, lambda c: F.col(f"head.{c}")))
    first = F.col("class") < F.col("head.class")
    return pairs.select(
        F.when(first, F.col("class")).otherwise(F.col("head.class")).alias("a"),
        F.when(first, F.col("head.class")).otherwise(F.col("class")).alias("b"),
        F.when(first, F.col("n")).otherwise(F.col("head.n")).alias("n_a"),
        F.when(first, F.col("head.n")).otherwise(F.col("n")).alias("n_b"),
    ).distinct()


def _rest(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list across components."""
    left = lists.select("code", *[F.col(c).alias(c + "_a") for c in (*_POSTING, "label")])
    right = lists.select("code", *[F.col(c).alias(c + "_b") for c in (*_POSTING, "label")])
    pairs = left.join(
        right,
        (left["code"] == right["code"])
        & (F.col("class_a") < F.col("class_b"))
        & (F.col("label_a") != F.col("label_b"))
        & _may_reach(percent, lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b")),
    )
    return pairs.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"), "n_a", "n_b").distinct()


def _unlike_bits(a: Column, b: Column) -> Column:
    """Bits in which two signatures differ; the longer is folded to the length of the other.

    Sizes at the threshold give lengths that differ by one doubling at most, if the threshold is above one half.
    """
    xor = lambda x, y: x.bitwiseXOR(y)
    half = lambda s: F.shiftright(F.size(s), 1)
    fold = lambda s: F.zip_with(F.slice(s, F.lit(1), half(s)), F.slice(s, half(s) + 1, half(s)), xor)
    count = lambda x, y: F.aggregate(F.zip_with(x, y, xor), F.lit(0), lambda n, bits: n + F.bit_count(bits))
    return (
        F.when(F.size(a) == F.size(b), count(a, b))
        .when(F.size(a) == 2 * F.size(b), count(fold(a), b))
        .when(2 * F.size(a) == F.size(b), count(a, fold(b)))
        .otherwise(F.lit(0))
    )


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures differ in no more bits than their sets may in n-grams."""
    ours = classes.select(F.col("class").alias("a"), F.col("signature").alias("signature_a"))
    theirs = classes.select(F.col("class").alias("b"), F.col("signature").alias("signature_b"))
    unlike = _unlike_bits(F.col("signature_a"), F.col("signature_b"))
    both = pairs.join(ours, "a").join(theirs, "b")
    return both.where(_alike(unlike, F.col("n_a") + F.col("n_b"), percent)).select("a", "b", "n_a", "n_b")


def _links(space: Workspace, pairs: DataFrame, classes: DataFrame, texts: DataFrame, order: Order, join: Join) -> DataFrame:
    """Pairs that reach the threshold: overlaps per fragment, summed per pair."""
    pairs = space.keep(_plausible(pairs, classes, join.percent), "plausible-pairs")
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = space.keep(wanted.join(classes.select("class", "least", "text_hash"), "class"), "wanted-sets")
    found = where_in_filter(texts, "text_hash", hash_filter(wanted, "text_hash")).join(
        wanted.select("class", F.col("least").alias("key_"), F.col("text_hash").alias("hash_")),
        (F.col("text_hash") == F.col("hash_")) & F.col("key").eqNullSafe(F.col("key_")),
    )
    cut = space.keep(segments(found, order, join), "segments")
    ours = cut.select(F.col("class").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    theirs = cut.select(F.col("class").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    partial = (
        pairs.join(ours, "a")
        .join(theirs, ["b", "fragment"])
        .select("a", "b", "n_a", "n_b", "fragment", F.size(F.array_intersect("grams_a", "grams_b")).alias("shared"))
    )
    # Rows repeated in the table give a fragment more than once, always with the same count.
    once = partial.groupBy("a", "b", "n_a", "n_b", "fragment").agg(F.max("shared").alias("shared"))
    total = once.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    linked = (100 + join.percent) * F.col("shared") >= join.percent * (F.col("n_a") + F.col("n_b"))
    linked_pairs = space.keep(total.where(linked).select("a", "b"), "links")
    for name in ("segments", "wanted-sets", "plausible-pairs"):
        space.drop(name)
    return linked_pairs


def memberships(documents: DataFrame, join: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, text_hash, n (size of its set), class (null if empty), component (a class) and
    component_key (the least key of the component)."""
    bounded_batches(documents.sparkSession)
    space = Workspace(documents.sparkSession, "ngram-join")
    body = documents[text]
    texts = documents.select(documents[key].alias("key"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    order = global_order(texts.select("text"), join)
    rows = space.keep(describe(texts, order, join), "sets")
    clash = F.raise_error(F.lit("two sets share a 64-bit identity")).cast("long")
    classes = (
        rows.where("class is not null")
        .groupBy("class")
        .agg(
            F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_hash")).alias("chosen"),
            F.first("n").alias("n"),
            F.min("class_rest").alias("rest"),
            F.max("class_rest").alias("rest_too"),
            F.first("prefix").alias("prefix"),
            F.first("signature").alias("signature"),
        )
        .select(
            "class",
            F.col("chosen.key").alias("least"),
            F.col("chosen.text_hash").alias("text_hash"),
            F.when(F.col("rest") != F.col("rest_too"), clash).otherwise(F.col("n")).alias("n"),
            "prefix",
            "signature",
            _folded(0).alias("even"),
            _folded(1).alias("odd"),
        )
    )
    classes = space.keep(classes, "classes")
    rows = space.keep(rows.select("key", "text_hash", "n", "class"), "rows")
    space.drop("sets")
    postings = _postings(classes, space)
    first = space.keep(_first_round(postings, join.percent), "pairs")
    links = _links(space, first, classes, texts, order, join)
    labels, compared, lists = components(links, space), first.select("a", "b"), postings
    for number in range(join.draws + 1):
        lists = _mixed_lists(space, lists, labels)
        if not number:
            space.drop("postings")
        pairs = _drawn_heads(lists, join, number) if number < join.draws else _rest(lists, join.percent)
        pairs = space.keep(pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        compared = compared.union(pairs.select("a", "b"))
        links = links.union(_links(space, pairs, classes, texts, order, join))
        labels = components(links, space)
    labelled = classes.select("class", "least").join(labels.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.select("class", "least", F.coalesce("label", "class").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_key"))
    members = labelled.join(least, "component").select("class", "component", "component_key")
    result = rows.select("key", "text_hash", "n", "class").join(members, "class", "left")
    return space.result(result, "memberships")


def near_copies(documents: DataFrame, join: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_shingles and component_id."""
    component = F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_key"))
    return memberships(documents, join, key, text).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def keep_one(documents: DataFrame, join: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, one row of each component: that with the least key, then text hash.

    Rows without words stay, since they are linked with nothing.
    """
    rows = memberships(documents, join, key, text).where("class is not null")
    rank = F.struct(F.col("key").isNull().alias("none"), "key", "text_hash")
    chosen = rows.groupBy("component").agg(F.min(rank).alias("one")).select("one.key", "one.text_hash")
    counted = rows.groupBy("key", "text_hash").agg(F.count("*").alias("m"))
    repeated = counted.where("m > 1").select("key", "text_hash")
    removed = materialise(counted.select("key", "text_hash").subtract(chosen), "removed-rows")
    return without_rows(documents, removed, key, text, materialise(repeated, "repeated-rows"))
