"""Line-first cleaning: lines are judged one by one, then what is left of the document.

A line with words fails when it meets one of three rules:

* punctuation: more than a tenth of the code points of its words are symbols,
* navigation: at least three of its words and a fifth of them are bare separators, or the
  whole line is an item of a site menu,
* boilerplate: it holds one of the phrases that sites repeat around their content.

Failing lines are removed. A document is rejected when it fails the base thresholds
(too few words, too many repeated windows of words) or when the lines removed held more
than a share of the code points of all its words.

Nothing is shuffled: every document is judged by itself, in one pass over Arrow batches.

Defined results: a null or empty text has no words and is rejected; repeated rows are judged
each for itself; an empty table gives an empty one; further columns pass through untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import bounded_batches

# Characters and texts of the rules.
BASE_SYMBOLS = "#*$%&|<>"
LINE_SYMBOLS = "#*$%&|<>!{}[]~^\\"
SEPARATORS = ("|", ">", ">>", "-", "/", "*", "•", "·", "»")
MENU_ITEMS = (
    "about us", "back to top", "contact us", "home", "log in", "login", "menu", "next", "previous", "read more",
    "register", "search", "share", "sign in", "sign up", "site map", "skip to content", "skip to main content",
)
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "cookies to", "enable javascript", "privacy policy",
    "subscribe to our newsletter", "terms of service", "terms of use",
)

_SPACES = b" \t\n\x0b\x0c\r"
_BASE_SYMBOLS = BASE_SYMBOLS.encode()
_LINE_SYMBOLS = LINE_SYMBOLS.encode()
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SEPARATORS = frozenset(s.encode() for s in SEPARATORS)
_MENU_ITEMS = frozenset(s.encode() for s in MENU_ITEMS)
_BOILERPLATE = tuple(s.encode() for s in BOILERPLATE)
_CONTINUATION = bytes(range(0x80, 0xC0))

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_failed_lines long, failed_chars long"
)


@dataclass(frozen=True)
class Limits:
    """Thresholds; percentages are compared in whole numbers."""

    least_words: int = 20
    window: int = 8
    most_repeated_pct: int = 30
    most_removed_pct: int = 40
    symbol_pct: int = 10
    separators: int = 3
    separator_pct: int = 20


def repeated_words(words: list[bytes], size: int) -> int:
    """Words inside windows of ``size`` words that occur at least twice, the first included.

    Words are numbered, then windows of twice the length are numbered from pairs of
    numbers, so equal numbers mean equal windows.
    """
    count = len(words) - size + 1
    if count < 2:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(number) == len(words):
        return 0
    length = 1
    while length < size:
        step = min(length, size - length)
        pairs = codes[: len(codes) - step] * np.int64(len(words)) + codes[step:]
        distinct, codes = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        length += step
    often = np.bincount(codes)[codes] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:count] += often
    edge[size:] -= often
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _code_points(data: bytes) -> int:
    return len(data.translate(None, _CONTINUATION))


def line_fails(line: bytes, words: list[bytes], limits: Limits) -> bool:
    """Whether a line with words meets one of the three rules."""
    body = line.translate(None, _SPACES)
    symbols = len(body) - len(body.translate(None, _LINE_SYMBOLS))
    if 100 * symbols > limits.symbol_pct * _code_points(body):
        return True
    bare = sum(w in _SEPARATORS for w in words)
    if bare >= limits.separators and 100 * bare >= limits.separator_pct * len(words):
        return True
    low = line.translate(_UPPER)
    return low.strip(_SPACES) in _MENU_ITEMS or any(phrase in low for phrase in _BOILERPLATE)


def judge(text: str | None, limits: Limits) -> tuple[tuple, str | None]:
    """The figures of ``COLUMNS`` and the text without its failing lines."""
    data = (text or "").encode()
    words = data.split()
    seen: set[bytes] = set()
    kept_lines, repeated_lines, failed, failed_chars = [], 0, 0, 0
    lines = data.split(b"\n")
    for line in lines:
        own = line.split()
        if own:
            if line in seen:
                repeated_lines += 1
            seen.add(line)
            if line_fails(line, own, limits):
                failed += 1
                failed_chars += _code_points(line.translate(None, _SPACES))
                continue
        kept_lines.append(line)
    word_chars = _code_points(data.translate(None, _SPACES))
    symbols = len(data) - len(data.translate(None, _BASE_SYMBOLS))
    repeated = repeated_words(words, limits.window)
    base_failed = len(words) < limits.least_words or 100 * repeated > limits.most_repeated_pct * len(words)
    kept = not base_failed and 100 * failed_chars <= limits.most_removed_pct * word_chars
    figures = (len(words), word_chars, symbols, repeated_lines, repeated, base_failed, kept, failed, failed_chars)
    return figures, text if not failed else b"\n".join(kept_lines).decode()


def assess(documents: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures and verdict of every document: the key and ``COLUMNS``."""
    bounded_batches(documents.sparkSession)
    chosen = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t, limits)[0] for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * 9
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[str(i) for i in range(10)])

    return chosen.mapInArrow(run, f"`{key}` {kind}, {COLUMNS}")


def clean(documents: DataFrame, limits: Limits = Limits(), text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents kept, without their failing lines; the other columns as they were.

    ``length`` names a column that counts the code points of the text, where there is one.
    """
    bounded_batches(documents.sparkSession)
    at = documents.columns.index(text)
    size_at = documents.columns.index(length) if length in documents.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [judge(t, limits) for t in batch.column(at).to_pylist()]
            keep = [figures[6] for figures, _ in judged]
            texts = [t for (figures, t) in judged if figures[6]]
            columns = batch.filter(pa.array(keep, type=pa.bool_())).columns
            columns[at] = pa.array(texts, type=batch.schema.field(at).type)
            if size_at is not None:
                columns[size_at] = pa.array([len(t) for t in texts], type=batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.mapInArrow(run, documents.schema)
