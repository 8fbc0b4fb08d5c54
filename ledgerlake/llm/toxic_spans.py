"""Toxicity by tagging: a linear-chain conditional random field marks words, documents are scored from their marks.

Labels are given for documents, not for words. So words are labelled first: in a toxic text those that hold a *marker*, a word,
prefix or suffix which toxic texts use far more than others do (log-likelihood ratio and share above thresholds). What is counted are
distinct contexts (the word with its neighbours), so a text and its copies count once. All words of other texts are labelled clean.

The field has two tags and, for each word, a weight for it, its prefixes and suffixes, its shape and both neighbours (those that occur at least twice in the training windows),
besides weights for the change of tags. It is trained by the gradient of the log-likelihood over windows of words. The marginal of each word, the
probability of the toxic tag given the whole text, comes from the forward-backward recursion: products of 2 x 2 matrices that
are combined in chunks, so that many texts run at once and a very long one takes no more steps than others.
A text's score is a logistic function of its marginals (their sum and number above a floor, the largest, and their share of words),
fitted on labelled rows that the field hasn't seen. Offending spans are runs of words whose marginal is at least one half.

Learned from rows only whose ``crc32(key as text) mod 5`` isn't 0, at most ``toxic_rows`` and ``clean_rows`` of them, those with the smallest
hash; every document is scored, over its whole text, in one pass without a shuffle. Weights follow from the text alone.

Defined results: a null or empty text has no words and gets the score of a text without marks; ids with both labels and labels that are null or
neither 0 nor 1 aren't used; without rows of both labels (or without a marker) every score is the share of toxic rows among those learned
from, 0 without any; repeated rows are scored each for itself; an empty table gives an empty one; a null id is not held
out; further columns aren't read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import CACHED_WORDS, Workspace, bounded_batches, mix

WORD = re.compile(r"\w+")
PREFIXES, SUFFIXES = range(3, 9), range(3, 6)
SLOTS = 2 + 1 + len(PREFIXES) + len(SUFFIXES) + 2  # bias and shape, the word and its pieces, both neighbours
# Kinds of weights: any word, its shape, itself, its prefixes, its suffixes, the word before, the word after.
KINDS = ("any", "shape", "word", "prefix", "suffix", "before", "after")
FOLDS = 4  # one of them fits the document score
TRAITS = 5
CHUNK = 32


@dataclass(frozen=True)
class Fit:
    """Labelled rows learned from at most, by label; what makes a marker: log-likelihood ratio, share of toxic contexts, and how many
    there may be; windows of a text and words of a window; passes and penalty of the training; the marginal above which
    a word counts for the score.
    """

    toxic_rows: int = 4000
    clean_rows: int = 10000
    ratio: float = 40.0
    share_pct: int = 75
    markers: int = 20000
    windows: int = 4
    window: int = 16
    passes: int = 80
    penalty: float = 2e-6
    floor: float = 0.05


@dataclass(frozen=True)
class Model:
    """Weights of the field by kind (None: no field), weights of its turns, of a text's traits, and the score without a field."""

    weights: dict[str, dict[str, float]] | None
    turns: np.ndarray
    traits: np.ndarray
    constant: float


def _hash(kind: str, piece: str) -> int:
    return xxhash.xxh3_64_intdigest(kind + piece)


def pieces(word: str) -> list[int]:
    """Hashes of a lower-cased word, its prefixes and its suffixes."""
    found = [_hash("w", word)]
    found += [_hash("p", word[:k]) for k in PREFIXES if len(word) >= k]
    return found + [_hash("s", word[-k:]) for k in SUFFIXES if len(word) >= k]


def _shape(word: str) -> str:
    kind = "upper" if word.isupper() and len(word) > 1 else "title" if word[0].isupper() else "lower"
    return kind if word.isalpha() else kind + " mixed"


def own_features(word: str) -> list[tuple[str, str]]:
    """Kind and name of the weights that a word contributes to at its own place."""
    low = word.lower()
    found = [("any", ""), ("shape", _shape(word)), ("word", low)]
    found += [("prefix", low[:k]) for k in PREFIXES if len(low) >= k]
    return found + [("suffix", low[-k:]) for k in SUFFIXES if len(low) >= k]


def _edges(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first and the last word of each text that has words."""
    ends = np.cumsum(lengths)
    held = lengths > 0
    return (ends - lengths)[held], ends[held] - 1


class WordScores(dict):
    """Numbers of words, with their weights at their own place, at the place after and the place before them."""

    def __init__(self, weights: dict[str, dict[str, float]]):
        super().__init__()
        self.weights, self.any = weights, weights["any"].get("", 0.0)
        self.prefixes, self.suffixes = weights["prefix"], weights["suffix"]
        self.own: list[float] = []
        self.next: list[float] = []
        self.previous: list[float] = []

    def __missing__(self, word: str) -> int:
        low, weights = word.lower(), self.weights
        value = self.any + weights["shape"].get(_shape(word), 0.0) + weights["word"].get(low, 0.0)
        # What is longer occurs no more often: where a piece has no weight, longer ones have none either.
        known, size = self.prefixes, len(low)
        for k in PREFIXES:
            if k > size or (piece := low[:k]) not in known:
                break
            value += known[piece]
        known = self.suffixes
        for k in SUFFIXES:
            if k > size or (piece := low[-k:]) not in known:
                break
            value += known[piece]
        self.own.append(value)
        self.next.append(weights["before"].get(low, 0.0))
        self.previous.append(weights["after"].get(low, 0.0))
        number = self[word] = len(self.own) - 1
        return number

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts, one after the other, and the words per text."""
        if len(self) >= CACHED_WORDS:
            self.clear()
            self.own, self.next, self.previous = [], [], []
        ids, lengths = [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            words = WORD.findall(text) if text else []
            lengths[i] = len(words)
            ids.append(np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words)))
        return np.concatenate(ids) if ids else np.empty(0, dtype=np.int64), lengths


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices (their four elements along the first axis), scaled by their sums."""
    out = np.empty(np.broadcast_shapes(x.shape, y.shape))
    out[0], out[1] = x[0] * y[0] + x[1] * y[2], x[0] * y[1] + x[1] * y[3]
    out[2], out[3] = x[2] * y[0] + x[3] * y[2], x[2] * y[1] + x[3] * y[3]
    out /= out.sum(axis=0)
    return out


def _first_rows(matrices: np.ndarray) -> np.ndarray:
    """First rows (2 x count) of the products of the first 1, 2, ... matrices (4 x count), scaled.

    Chunks are multiplied side by side, then the chunks' own products, then the two put together.
    """
    count = matrices.shape[1]
    chunks = -(-count // CHUNK)
    padded = np.zeros((4, chunks * CHUNK))
    padded[0], padded[3] = 1.0, 1.0
    padded[:, :count] = matrices
    part = np.ascontiguousarray(padded.reshape(4, chunks, CHUNK).transpose(0, 2, 1))
    for i in range(1, CHUNK):
        part[:, i] = _times(part[:, i - 1], part[:, i])
    rows = part[:2].copy()
    if chunks > 1:
        before = _first_rows(part[:, -1, :-1])[:, None, :]
        rows[0, :, 1:] = before[0] * part[0, :, 1:] + before[1] * part[2, :, 1:]
        rows[1, :, 1:] = before[0] * part[1, :, 1:] + before[1] * part[3, :, 1:]
        rows /= rows.sum(axis=0)
    return rows.transpose(0, 2, 1).reshape(2, -1)[:, :count]


def marginals(scores: np.ndarray, lengths: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag for every word of texts that stand one after the other.

    ``scores`` favour that tag; ``turns`` are the weights of (tag before, tag). At the edge of a text the
    matrix forgets what came before it.
    """
    if not len(scores):
        return np.empty(0)
    first, last = _edges(lengths)
    clean, toxic = np.exp(-np.maximum(scores, 0.0)), np.exp(np.minimum(scores, 0.0))
    change = np.exp(turns - turns.max())
    forward = np.stack([change[0, 0] * clean, change[0, 1] * toxic, change[1, 0] * clean, change[1, 1] * toxic])
    forward[:, first] = np.stack([clean, toxic, clean, toxic])[:, first]
    ahead = _first_rows(forward)
    # Backward: the product of what follows each word, from the end of its text.
    backward = np.ones((4, len(scores)))
    backward[:, :-1] = np.stack([change[0, 0] * clean, change[1, 0] * clean, change[0, 1] * toxic, change[1, 1] * toxic])[:, 1:]
    backward[:, last] = 1.0
    behind = _first_rows(backward[:, ::-1])[:, ::-1]
    both = ahead * behind
    return both[1] / both.sum(axis=0)


def word_marginals(texts: list[str | None], model: Model, memory: WordScores) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all words of the texts, one after the other, and the words per text."""
    ids, lengths = memory.numbered(texts)
    if not len(ids):
        return np.empty(0), lengths
    own, after, before = np.array(memory.own), np.array(memory.next), np.array(memory.previous)
    first, last = _edges(lengths)
    left, right = after[np.roll(ids, 1)], before[np.roll(ids, -1)]
    left[first], right[last] = 0.0, 0.0
    return marginals(own[ids] + left + right, lengths, model.turns), lengths


def traits(found: np.ndarray, lengths: np.ndarray, floor: float) -> np.ndarray:
    """What the score of a text follows from: rows x ``TRAITS``, the first of them constant."""
    out = np.zeros((len(lengths), TRAITS))
    out[:, 0] = 1.0
    if len(found):
        owner = np.repeat(np.arange(len(lengths)), lengths)
        strong = np.where(found >= floor, found, 0.0)
        mass = np.bincount(owner, weights=strong, minlength=len(lengths))
        np.maximum.at(out[:, 2], owner, found)
        out[:, 1] = np.log1p(mass)
        out[:, 3] = np.log1p(np.bincount(owner, weights=found >= 0.5, minlength=len(lengths)))
        out[:, 4] = np.log1p(1000 * mass / np.maximum(lengths, 1))
    return out


def document_scores(values: np.ndarray, model: Model) -> np.ndarray:
    if model.weights is None:
        return np.full(len(values), model.constant)
    return 1 / (1 + np.exp(-np.clip(values @ model.traits, -50, 50)))


def spans_of(text: str, found: np.ndarray) -> list[tuple[int, int]]:
    """Runs of words marked toxic, as code points, the end exclusive."""
    spans: list[tuple[int, int]] = []
    joined = False
    for word, value in zip(WORD.finditer(text), found):
        if value >= 0.5:
            spans.append((spans.pop()[0] if joined else word.start(), word.end()))
        joined = value >= 0.5
    return spans


def _learned(labels: DataFrame, fit: Fit) -> tuple[DataFrame, np.ndarray]:
    """Ids to learn from (``labelled, toxic``), few by bound, and how many ids of each label there are."""
    usable = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .where(~held_out("doc_id"))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most"))
        .where("toxic = most")
        .select("labelled", "toxic")
    )
    counts = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [
        usable.where(F.col("toxic") == toxic).orderBy(F.xxhash64("labelled"), "labelled").limit(rows)
        for toxic, rows in ((0, fit.clean_rows), (1, fit.toxic_rows))
    ]
    return parts[0].union(parts[1]), np.array([counts.get(0, 0), counts.get(1, 0)], dtype=np.float64)


def held_out(key: str):
    """Whether rows of this id are kept from learning."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _contexts(sample: DataFrame) -> DataFrame:
    """``word, n0, n1``: distinct contexts of every word in clean and in toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number: dict[str, int] = {}
            texts = [WORD.findall(text) if text else [] for text in batch.column(0).to_pylist()]
            lengths = np.array([len(words) for words in texts], dtype=np.int64)
            ids = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), dtype=np.int64, count=lengths.sum())
            if not len(ids):
                continue
            words = list(number)
            low = [w.lower() for w in words]
            codes = np.fromiter(map(xxhash.xxh3_64_intdigest, low), dtype=np.uint64, count=len(low))[ids]
            first, last = _edges(lengths)
            left, right = np.roll(codes, 1), np.roll(codes, -1)
            left[first], right[last] = 0, 0
            context = mix(mix(mix(left) + codes) + right).view(np.int64)
            toxic = np.repeat(batch.column(1).to_numpy(), lengths)
            _, kept = np.unique(np.stack([context, toxic]), axis=1, return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(context[kept]), pa.array(low, pa.string()).take(pa.array(ids[kept])), pa.array(toxic[kept], pa.int32())],
                names=["context", "word", "toxic"],
            )

    found = sample.select("text", "toxic").mapInArrow(run, "context long, word string, toxic int")
    once = found.groupBy("context", "word").agg(F.max("toxic").alias("n1"), F.max(1 - F.col("toxic")).alias("n0"))
    return once.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def markers(contexts: DataFrame, fit: Fit) -> frozenset[int]:
    """Hashes of the pieces that mark toxic texts, those of the largest ratios."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(pieces(w), dtype=np.uint64) for w in batch.column(0).to_pylist()]
            sizes = [len(f) for f in found]
            piece = np.concatenate(found).view(np.int64) if found else np.empty(0, dtype=np.int64)
            counts = [pa.array(np.repeat(batch.column(i).to_numpy(), sizes), pa.int64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(piece), *counts], names=["piece", "n0", "n1"])

    all_of = contexts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not all_of.n0 or not all_of.n1:
        return frozenset()
    share = all_of.n1 / (all_of.n0 + all_of.n1)
    n0, n1 = F.col("n0"), F.col("n1")

    def part(n, expected: float):
        return F.when(n > 0, n * F.log(n / ((n0 + n1) * F.lit(expected)))).otherwise(0.0)

    counted = contexts.mapInArrow(run, "piece long, n0 long, n1 long").groupBy("piece").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    chosen = (
        counted.withColumn("ratio", 2 * (part(n1, share) + part(n0, 1 - share)))
        .where((100 * n1 >= fit.share_pct * (n0 + n1)) & (n1 > (n0 + n1) * F.lit(share)) & (F.col("ratio") >= fit.ratio))
        .orderBy(F.desc("ratio"), "piece")
        .limit(fit.markers)
    )
    return frozenset(r.piece & 0xFFFFFFFFFFFFFFFF for r in chosen.select("piece").collect())  # bounded by fit.markers


def _windows(marked: np.ndarray, offset: int, fit: Fit) -> list[int]:
    """Starts of windows over a text's words: around marked ones, and one wherever the text's hash says."""
    count = len(marked)
    starts, until = [offset % max(1, count - fit.window + 1)], -1
    for place in np.flatnonzero(marked).tolist():
        if len(starts) >= fit.windows:
            break
        if place >= until:
            start = max(0, min(place - fit.window // 2, count - fit.window))
            starts.append(start)
            until = start + fit.window
    return starts


def _training_windows(sample: DataFrame, chosen: frozenset[int], fit: Fit) -> DataFrame:
    """``words, tags``: windows of words with the word on either side ("" beyond the text), and their labels (-1 beyond it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows, tags = [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORD.findall(text) if text else []
                if not words:
                    continue
                marker = {w: not chosen.isdisjoint(pieces(w.lower())) for w in set(words)}
                marked = np.fromiter(map(marker.__getitem__, words), dtype=bool, count=len(words))
                for start in _windows(marked, xxhash.xxh3_64_intdigest(text), fit):
                    places = range(start - 1, start + fit.window + 1)
                    windows.append([words[i] if 0 <= i < len(words) else "" for i in places])
                    tags.append([toxic and int(marked[i]) if i < len(words) else -1 for i in places[1:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.int32()))], names=["words", "tags"]
            )

    return sample.select("text", "toxic").mapInArrow(run, "words array<string>, tags array<int>")


def numbered_features(words: list[str], width: int) -> tuple[np.ndarray, list[tuple[str, str]]]:
    """Features of windows that stand one after the other: rows x words x slots, and the names of those that occur twice.

    Each window has ``width`` words and one more on either side. Number 0 stands for nothing.
    """
    number: dict[tuple[str, str], int] = {}
    distinct: dict[str, int] = {}
    ids = np.fromiter((distinct.setdefault(w, len(distinct)) for w in words), dtype=np.int64, count=len(words)).reshape(-1, width + 2)
    slots = np.zeros((len(distinct), SLOTS), dtype=np.int64)
    for i, word in enumerate(distinct):
        if word:
            own = own_features(word)
            names = own + [("", "")] * (SLOTS - 2 - len(own)) + [("before", word.lower()), ("after", word.lower())]
            slots[i] = [number.setdefault(n, len(number) + 1) if n[0] else 0 for n in names]
    features = np.empty((len(ids), width, SLOTS), dtype=np.int64)
    features[:, :, : SLOTS - 2] = slots[ids[:, 1:-1], : SLOTS - 2]
    features[:, :, SLOTS - 2] = slots[ids[:, :-2], SLOTS - 2]
    features[:, :, SLOTS - 1] = slots[ids[:, 2:], SLOTS - 1]
    features[ids[:, 1:-1] == distinct.get("", -1)] = 0
    counts = np.bincount(features.ravel(), minlength=len(number) + 1)
    often = counts >= 2
    often[0] = False
    renumbered = np.where(often, np.cumsum(often), 0)
    return renumbered[features], [name for name, i in number.items() if often[i]]


def _expected(scores: np.ndarray, lengths: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag marginals of windows (rows x words) and the expected number of each change of tags."""
    count, width = scores.shape
    inside = np.arange(width)[None] < lengths[:, None]
    emit = np.stack([np.exp(-np.maximum(scores, 0.0)), np.exp(np.minimum(scores, 0.0))], axis=2)
    emit = np.where(inside[:, :, None], emit, 1.0)
    change = np.exp(turns - turns.max())
    ahead, behind = np.empty((count, width, 2)), np.ones((count, width, 2))
    ahead[:, 0] = emit[:, 0]
    for i in range(1, width):
        step = (ahead[:, i - 1] @ change) * emit[:, i]
        ahead[:, i] = step / step.sum(axis=1, keepdims=True)
    for i in range(width - 2, -1, -1):
        step = np.where(inside[:, i + 1, None], (behind[:, i + 1] * emit[:, i + 1]) @ change.T, 1.0)
        behind[:, i] = step / step.sum(axis=1, keepdims=True)
    both = ahead * behind
    tags = np.where(inside, both[:, :, 1] / both.sum(axis=2), 0.0)
    pairs = ahead[:, :-1, :, None] * change[None, None] * (emit[:, 1:] * behind[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return tags, (pairs * inside[:, 1:, None, None]).sum(axis=(0, 1))


def train_field(features: np.ndarray, count: int, tags: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Weights 1 to ``count`` and turns: steps over all windows, scaled per weight by the gradients so far.

    ``features`` are rows x words x slots (0: none), ``tags`` rows x words (-1 beyond the text).
    """
    lengths = (tags >= 0).sum(axis=1)
    truth = np.maximum(tags, 0)
    inside = tags[:, 1:] >= 0
    seen_turns = np.array([[((truth[:, :-1] == a) & (truth[:, 1:] == b) & inside).sum() for b in (0, 1)] for a in (0, 1)])
    weights, turns = np.zeros(count + 1), np.zeros((2, 2))
    past, past_turns = np.full(count + 1, 1e-10), np.full((2, 2), 1e-10)
    words, flat = max(1, lengths.sum()), features.ravel()
    for _ in range(fit.passes):
        found, expected = _expected(weights[features].sum(axis=2), lengths, turns)
        error = np.where(tags >= 0, found - truth, 0.0) / words
        step = np.bincount(flat, weights=np.repeat(error.ravel(), SLOTS), minlength=count + 1) + fit.penalty * weights
        step[0] = 0.0
        past += step * step
        weights -= 0.3 * step / np.sqrt(past)
        turn = (expected - seen_turns) / words + fit.penalty * turns
        past_turns += turn * turn
        turns -= 0.3 * turn / np.sqrt(past_turns)
    return weights, turns


def _trait_rows(sample: DataFrame, model: Model, fit: Fit) -> DataFrame:
    """``toxic`` and the traits of every row of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordScores(model.weights)
        for batch in batches:
            found, lengths = word_marginals(batch.column(0).to_pylist(), model, memory)
            values = traits(found, lengths, fit.floor)
            columns = [pa.array(values[:, i]) for i in range(TRAITS)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], names=["toxic", *(f"t{i}" for i in range(TRAITS))])

    return sample.select("text", "toxic").mapInArrow(run, "toxic int, " + ", ".join(f"t{i} double" for i in range(TRAITS)))


def fit_score(values: np.ndarray, toxic: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Weights of a logistic function of the traits; rows stand for as many as there are of their label."""
    held = np.array([max(1, (toxic == k).sum()) for k in (0, 1)])
    rows = (totals / held)[toxic]
    rows = rows / rows.sum()
    mean, spread = values[:, 1:].mean(axis=0), values[:, 1:].std(axis=0) + 1e-3
    scaled = np.concatenate([values[:, :1], (values[:, 1:] - mean) / spread], axis=1)
    weights, ridge = np.zeros(TRAITS), 1e-3 * np.eye(TRAITS)
    for _ in range(50):  # Newton steps, damped
        p = 1 / (1 + np.exp(-np.clip(scaled @ weights, -30, 30)))
        slope = scaled.T @ (rows * (p - toxic)) + ridge @ weights
        bend = (scaled * (rows * p * (1 - p))[:, None]).T @ scaled + ridge
        step = np.linalg.solve(bend, slope)
        weights -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    out = weights.copy()
    out[1:] = weights[1:] / spread
    out[0] -= (weights[1:] * mean / spread).sum()
    return out


def learn(documents: DataFrame, labels: DataFrame, fit: Fit = Fit(), key: str = "doc_id", text: str = "text") -> Model:
    """The field and the document score, from labelled rows that aren't held out."""
    bounded_batches(documents.sparkSession)
    space = Workspace(documents.sparkSession, "toxicity")
    chosen, totals = _learned(labels, fit)
    constant = float(totals[1] / totals.sum()) if totals.sum() else 0.0
    without = Model(None, np.zeros((2, 2)), np.zeros(TRAITS), constant)
    body = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    # At most toxic_rows + clean_rows ids with a number each.
    sample = body.join(F.broadcast(chosen), F.col("key") == F.col("labelled"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(FOLDS)).cast("int")
    sample = space.keep(sample.select("text", "toxic", fold.alias("fold")), "sample")
    seen, unseen = sample.where("fold > 0"), sample.where("fold = 0")
    marks = markers(space.keep(_contexts(seen), "contexts"), fit)
    if not marks:
        space.close()
        return without
    most = fit.windows * (fit.toxic_rows + fit.clean_rows)
    rows = _training_windows(seen, marks, fit).orderBy(F.xxhash64("words"), "words", "tags").limit(most).toArrow()
    features, names = numbered_features(rows["words"].combine_chunks().flatten().to_pylist(), fit.window)
    tags = rows["tags"].combine_chunks().flatten().to_numpy().reshape(-1, fit.window)
    values, turns = train_field(features, len(names), tags, fit)
    weights: dict[str, dict[str, float]] = {kind: {} for kind in KINDS}
    for (kind, name), value in zip(names, values[1:].tolist()):
        weights[kind][name] = value
    model = Model(weights, turns, np.zeros(TRAITS), constant)
    order = [F.xxhash64(*[f"t{i}" for i in range(TRAITS)]), "toxic"]
    for part in (unseen, sample):  # all of the sample only where the unseen rows lack a label
        fitted = _trait_rows(part, model, fit).orderBy(*order).limit(fit.toxic_rows + fit.clean_rows).toArrow()
        toxic = fitted["toxic"].to_numpy().astype(np.int64)
        if len(set(toxic.tolist())) == 2:
            break
    space.close()
    if len(set(toxic.tolist())) < 2:
        return without
    values = np.stack([fitted[f"t{i}"].to_numpy() for i in range(TRAITS)], axis=1)
    return Model(weights, turns, fit_score(values, toxic, totals), constant)


def tag(documents: DataFrame, model: Model, fit: Fit = Fit(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, n_words, n_toxic_words, spans`` (lists of first and end code point) of every document."""
    bounded_batches(documents.sparkSession)
    chosen = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordScores(model.weights) if model.weights is not None else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if memory is None:
                found, lengths = np.empty(0), np.array([len(WORD.findall(t or "")) for t in texts], dtype=np.int64)
                values = np.zeros((len(texts), TRAITS))
            else:
                found, lengths = word_marginals(texts, model, memory)
                values = traits(found, lengths, fit.floor)
            ends = np.cumsum(lengths)
            marked, spans = np.zeros(len(texts), dtype=np.int64), [[] for _ in texts]
            if len(found):
                marked = np.bincount(np.repeat(np.arange(len(texts)), lengths), weights=found >= 0.5, minlength=len(texts)).astype(np.int64)
                for i in np.flatnonzero(marked):
                    spans[i] = [list(s) for s in spans_of(texts[i], found[ends[i] - lengths[i] : ends[i]])]
            columns = [
                batch.column(0), pa.array(document_scores(values, model)), pa.array(lengths), pa.array(marked),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "score", "n_words", "n_toxic_words", "spans"])

    schema = f"key {kind}, score double, n_words long, n_toxic_words long, spans array<array<long>>"
    return chosen.mapInArrow(run, schema).withColumnRenamed("key", key)


def judge(documents: DataFrame, labels: DataFrame, fit: Fit = Fit(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score and verdict of every document, whether its id is held out, and its offending spans."""
    tagged = tag(documents, learn(documents, labels, fit, key, text), fit, key, text)
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat(s[0].cast("string"), F.lit(":"), s[1].cast("string"))))
    return tagged.select(
        key,
        held_out(key).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "n_words",
        "n_toxic_words",
        spans.alias("spans"),
    )
