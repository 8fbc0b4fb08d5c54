"""Mixing to target weights with soft membership in domains.

A document does not belong to one domain: a classifier, fitted on labelled rows, gives it a
posterior over domains. Nonnegative rates (expected copies of each document) are then fitted
so that the expected tokens of every domain, ``sum(rate * tokens * posterior)``, match the targets in
the least-squares sense, by projected gradient steps from equal rates:

    rate <- max(0, rate - step * sum_k posterior_k * (total_k - target_k) / scale_k)

A step needs the K domain totals only, one small row from each task, and moves every document by its
own posterior. So the rate of a document follows from its posterior and the K numbers of
each step so far; no rates are stored, and a step is one pass over a narrow table.

The classifier is a softmax regression over the presence of common hashed words, shares of
symbols, capitals and bare marks, and the evidence of all words: for toxic and for poor texts, the
smoothed log-odds of each hashed word, counted over all labelled rows from ``least_texts`` texts on;
a text has the sum and the maximum of what lies above ``margin``. So words that are rare, as those of a
language with few texts are, still tell. The regression is fitted on at most ``SAMPLE`` labelled rows,
chosen by the hash of their id, whose evidence leaves out the rows of their own fold (equal texts share
one); counts, scores, totals and rates cover all documents.

Defined results: a null or empty text has no tokens, weighs nothing and gets the rate that its posterior
gives; labels with a null part are not used; repeated labels and documents count as often as they occur; without labels all
posteriors are equal; a domain that no document can belong to is left out of the fit; an empty
table gives an empty one; further columns are not read, or pass through ``resample``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import WordHashes, bounded_batches, materialise
from ledgerlake.llm.string_tiling import plain_words

SAMPLE = 6000
BUCKETS = 1 << 16
STYLES = 4
FOLDS = 5
DOMAINS = ("poor", "poor_toxic", "good", "good_toxic")
SIDES = ((1, 3), (0, 1))  # domains of toxic and of poor texts
EVIDENCE = 2 * len(SIDES)  # sum and maximum each
WEIGHTS = {"poor": 0.05, "poor_toxic": 0.01, "good": 0.92, "good_toxic": 0.02}

_SYMBOLS = b"#*$%&|<>!{}[]~^\\"
_UPPER = bytes(range(65, 91))
_SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Fit:
    """Of the classifier: passes, penalty, the percentage of texts a feature of its own must occur
    in, the number of texts a word must occur in to be evidence, and the log-odds it must exceed.
    Of the rates: most gradient steps, the share of the budget missed at which they end, and
    how often a domain may be repeated: its target is at most so many times what it has.
    """

    passes: int = 120
    penalty: float = 1e-3
    least_pct: int = 2
    least_texts: int = 5
    margin: float = 1.5
    steps: int = 60
    tolerance: float = 1e-4
    repeats: float = 1.0


@dataclass(frozen=True)
class Model:
    """A fitted classifier."""

    weights: np.ndarray  # features x domains
    odds: np.ndarray  # hashed words x sides


@dataclass(frozen=True)
class Mixture:
    """A fitted mixture: what a document's rate follows from, and how far the totals came."""

    model: Model
    start: float
    moves: np.ndarray  # steps x domains
    targets: np.ndarray
    totals: np.ndarray

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        return _rates(posteriors, self.start, self.moves)


def _rates(posteriors: np.ndarray, start: float, moves: np.ndarray) -> np.ndarray:
    rates = np.full(len(posteriors), start)
    for move in moves:
        rates = np.maximum(0.0, rates - posteriors @ move)
    return rates


def _buckets(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Distinct hashed words of a text."""
    words = hashes.of(plain_words(text))
    return np.unique((words >> np.uint64(7)).astype(np.int64) & (BUCKETS - 1))


def features(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features of texts: row, feature and value of each entry, and the tokens per text."""
    rows, columns, styles, tokens = [], [], np.zeros((len(texts), STYLES)), np.zeros(len(texts), dtype=np.int64)
    for number, text in enumerate(texts):
        buckets = _buckets(text, hashes)
        rows.append(np.full(len(buckets), number, dtype=np.int64))
        columns.append(buckets)
        data = (text or "").encode()
        raw, body = data.split(), data.translate(None, _SPACES)
        tokens[number] = len(raw)
        if raw:
            styles[number] = (
                1.0,
                8 * (len(body) - len(body.translate(None, _SYMBOLS))) / len(body),
                4 * (len(body) - len(body.translate(None, _UPPER))) / len(body),
                4 * len(set(raw)) / len(raw),
            )
        else:
            styles[number, 0] = 1.0
    row, column = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (rows, columns))
    count = len(texts)
    row = np.concatenate([row, np.repeat(np.arange(count), STYLES)])
    column = np.concatenate([column, np.tile(BUCKETS + np.arange(STYLES), count)])
    value = np.concatenate([np.ones(len(row) - count * STYLES), styles.ravel()])
    order = np.argsort(row, kind="stable")
    return row[order], column[order], value[order], tokens


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _scores(row: np.ndarray, column: np.ndarray, value: np.ndarray, count: int, weights: np.ndarray) -> np.ndarray:
    out = np.empty((count, weights.shape[1]))
    for k in range(weights.shape[1]):
        out[:, k] = np.bincount(row, weights=value * weights[column, k], minlength=count)
    return out


def _odds(counts: np.ndarray, rows: np.ndarray, fit: Fit) -> np.ndarray:
    """Per hashed word and side, its log-odds above the margin, from texts per word and domain."""
    odds = np.zeros((len(counts), len(SIDES)))
    seen = counts.sum(axis=1)
    for i, side in enumerate(SIDES):
        inside = counts[:, side].sum(axis=1)
        share = rows[list(side)].sum() / max(1.0, rows.sum())
        if 0 < share < 1:  # smoothed by one text with the share of all
            value = np.log((inside + share) / (seen - inside + 1 - share)) - np.log(share / (1 - share))
            odds[:, i] = np.where(seen >= fit.least_texts, np.maximum(0.0, value - fit.margin), 0.0)
    return odds


def _evidence(row: np.ndarray, column: np.ndarray, count: int, odds: np.ndarray) -> np.ndarray:
    """Sum and maximum of the odds of each text's words, for every side."""
    out = np.zeros((count, EVIDENCE))
    words = column < BUCKETS
    row, column = row[words], column[words]
    for i in range(len(SIDES)):
        value = odds[column, i]
        held = value > 0
        out[:, 2 * i] = np.bincount(row[held], weights=value[held], minlength=count)
        np.maximum.at(out[:, 2 * i + 1], row[held], value[held])
    return out


def _with_evidence(row: np.ndarray, column: np.ndarray, value: np.ndarray, evidence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    count, places = len(evidence), BUCKETS + STYLES + np.arange(EVIDENCE)
    return (
        np.concatenate([row, np.repeat(np.arange(count), EVIDENCE)]),
        np.concatenate([column, np.tile(places, count)]),
        np.concatenate([value, evidence.ravel()]),
    )


def word_counts(labelled: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts per hashed word and domain, and rows per domain, of all labelled rows (text, domain)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sums = WordHashes(), np.zeros((BUCKETS + 1) * count, dtype=np.int64)
        for batch in batches:
            for text, domain in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[_buckets(text, hashes) * count + domain] += 1
                sums[BUCKETS * count + domain] += 1
        cells = np.flatnonzero(sums)
        for low in range(0, len(cells), 1 << 16):
            part = cells[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(sums[part], pa.int64())], names=["cell", "n"])

    found = labelled.select("text", "domain").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = found.toArrow()  # at most one per hashed word and domain
    sums = np.zeros((BUCKETS + 1) * count)
    sums[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    sums = sums.reshape(BUCKETS + 1, count)
    return sums[:BUCKETS], sums[BUCKETS]


def train(texts: list[str | None], domains: list[int], count: int, fit: Fit, counts: np.ndarray, rows: np.ndarray) -> Model:
    """Softmax regression, whole-sample steps scaled per weight by the gradients so far.

    ``counts`` (texts per hashed word and domain) and ``rows`` (per domain) include the sample's; each fold's
    own are taken off for the evidence of its texts.
    """
    weights = np.zeros((BUCKETS + STYLES + EVIDENCE, count))
    if not texts:
        return Model(weights, np.zeros((BUCKETS, len(SIDES))))
    row, column, value, _ = features(texts, WordHashes())
    common = np.bincount(column, minlength=len(weights)) >= max(2, fit.least_pct * len(texts) // 100)
    truth = np.eye(count)[np.asarray(domains)]
    folds = np.array([xxhash.xxh3_64_intdigest(text or "") % FOLDS for text in texts])
    evidence = np.zeros((len(texts), EVIDENCE))
    for fold in range(FOLDS):
        own = folds == fold
        at = own[row] & (column < BUCKETS)
        held = np.stack([np.bincount(column[at], weights=truth[row[at], k], minlength=BUCKETS) for k in range(count)], axis=1)
        odds = _odds(np.maximum(0.0, counts - held), np.maximum(0.0, rows - truth[own].sum(axis=0)), fit)
        evidence[own] = _evidence(row, column, len(texts), odds)[own]
    known = common[column]
    row, column, value = _with_evidence(row[known], column[known], value[known], evidence)
    seen = np.full_like(weights, 1e-8)
    for _ in range(fit.passes):
        error = (_softmax(_scores(row, column, value, len(texts), weights)) - truth) / len(texts)
        for k in range(count):
            step = np.bincount(column, weights=value * error[row, k], minlength=len(weights)) + fit.penalty * weights[:, k]
            seen[:, k] += step * step
            weights[:, k] -= 0.3 * step / np.sqrt(seen[:, k])
    return Model(weights, _odds(counts, rows, fit))


def posteriors(texts: list[str | None], model: Model, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of every text and its tokens."""
    row, column, value, tokens = features(texts, hashes)
    row, column, value = _with_evidence(row, column, value, _evidence(row, column, len(texts), model.odds))
    return _softmax(_scores(row, column, value, len(texts), model.weights)), tokens


def classifier(documents: DataFrame, labels: DataFrame, fit: Fit, key: str, text: str) -> Model:
    """Word counts over all labelled rows, and weights fitted on at most ``SAMPLE`` of them."""
    usable = labels.where("quality in (0, 1) and toxic in (0, 1)").select(
        labels["doc_id"].alias("labelled"), (2 * F.col("quality") + F.col("toxic")).cast("int").alias("domain")
    )
    chosen = usable.orderBy(F.xxhash64("labelled"), "labelled", "domain").limit(SAMPLE)
    body = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    # All labels: never sent whole to every task, so that disk grows in proportion at any size.
    labelled = body.join(usable.hint("merge"), F.col("key") == F.col("labelled"))
    counts, seen = word_counts(labelled, len(DOMAINS))
    sample = body.join(F.broadcast(chosen), F.col("key") == F.col("labelled"))  # at most SAMPLE small rows
    # One id may stand on many rows: the bound holds for what comes back as well.
    sample = sample.orderBy(F.xxhash64("key"), "key", F.xxhash64("text"), "domain").limit(SAMPLE)
    rows = sample.select("text", "domain").toArrow()
    return train(rows["text"].to_pylist(), rows["domain"].to_pylist(), len(DOMAINS), fit, counts, seen)


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens and posterior of every document."""
    chosen = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found, tokens = posteriors(batch.column(1).to_pylist(), model, hashes)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel(), pa.float64())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64()), lists], names=["key", "n", "p"])

    return chosen.mapInArrow(run, f"`{key}` {kind}, n_tokens long, posterior array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(scored: DataFrame, width: int, compute) -> np.ndarray:
    """Sum over all documents of what ``compute(posteriors, tokens)`` gives: a short vector per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = compute(_matrix(batch.column(1), width), batch.column(0).to_numpy().astype(np.float64)).ravel()
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.float64())], names=["k", "v"])

    rows = scored.select("n_tokens", "posterior").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
    found = {r.k: r.v for r in rows.collect()}  # at most K * K numbers
    return np.array([found[k] for k in range(len(found))])


def solve(scored: DataFrame, weights: dict[str, float], budget: float | None, fit: Fit) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Start rate, steps, targets and totals reached."""
    width = len(DOMAINS)
    wanted = np.array([weights.get(d, 0.0) for d in DOMAINS])
    wanted = wanted / wanted.sum()
    # sum of tokens * posterior * posterior over all documents, K x K, and of tokens * posterior
    both = _sums(scored, width, lambda p, n: np.concatenate([((p * n[:, None]).T @ p).ravel(), n @ p]))
    if not len(both) or not both.any():
        return 0.0, np.zeros((0, width)), np.zeros(width), np.zeros(width)
    square, present = both[: width * width].reshape(width, width), both[width * width :]
    if budget is None:  # all of the domain that weighs most
        budget = float(present[wanted.argmax()] / wanted.max())
    targets = np.minimum(wanted * budget, fit.repeats * present)
    usable = np.diag(square) > 1e-9 * square.max()
    scale = np.where(usable, np.diag(square), 1.0)
    root = np.sqrt(scale)
    step = 1.0 / np.linalg.eigvalsh(np.where(np.outer(usable, usable), square / np.outer(root, root), 0.0)).max()
    start, moves = budget / present.sum(), np.zeros((0, width))
    totals, best = start * present, np.inf
    for _ in range(fit.steps):
        miss = np.where(usable, totals - targets, 0.0)
        loss = float((miss * miss / scale).sum())
        if np.abs(miss).max() <= fit.tolerance * budget or loss > best * (1 - 1e-4):
            break
        best = loss
        moves = np.vstack([moves, step * miss / scale])
        so_far = moves
        totals = _sums(scored, width, lambda p, n: (n * _rates(p, start, so_far)) @ p)
    return start, moves, targets, totals


def fit_mixture(
    documents: DataFrame,
    labels: DataFrame,
    weights: dict[str, float] | None = None,
    budget: float | None = None,
    fit: Fit = Fit(),
    key: str = "doc_id",
    text: str = "text",
) -> tuple[Mixture, DataFrame]:
    """The mixture and the scored documents (key, n_tokens, posterior)."""
    bounded_batches(documents.sparkSession)
    model = classifier(documents, labels, fit, key, text)
    scored = materialise(score(documents, model, key, text), "posteriors")
    start, moves, targets, totals = solve(scored, weights or WEIGHTS, budget, fit)
    return Mixture(model, start, moves, targets, totals), scored


def with_rates(scored: DataFrame, mixture: Mixture) -> DataFrame:
    """The scored documents with their rate."""
    width = len(DOMAINS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rates = mixture.rates(_matrix(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates, pa.float64())], names=[*batch.schema.names, "rate"])

    key = scored.columns[0]
    kind = scored.schema[key].dataType.simpleString()
    return scored.mapInArrow(run, f"`{key}` {kind}, n_tokens long, posterior array<double>, rate double")


def resample(documents: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """Each document as often as its rate says, with all its columns.

    The whole part of a rate is certain; the rest is drawn by the hash of id and text, so a
    run that is repeated draws the same.
    """
    bounded_batches(documents.sparkSession)
    names = documents.columns
    draw = F.pmod(F.xxhash64(documents[key], documents[text], F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    spot = "draw"
    while spot in names:
        spot += "_"
    drawn = documents.select(*[documents[c] for c in names], draw.alias(spot))
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found, _ = posteriors(batch.column(at).to_pylist(), mixture.model, hashes)
            copies = np.floor(mixture.rates(found) + batch.column(len(names)).to_numpy()).astype(np.int64)
            rows = np.repeat(np.arange(len(copies)), copies)
            for low in range(0, len(rows), max(1, len(copies))):  # batches no larger than those read
                part = pa.array(rows[low : low + max(1, len(copies))], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(i).take(part) for i in range(len(names))], names=names)

    return drawn.mapInArrow(run, documents.schema)
