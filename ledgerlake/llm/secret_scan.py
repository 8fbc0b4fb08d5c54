"""Secrets in texts: three fixed patterns and entropy windows over candidate strings.

Patterns are searched leftmost and without overlap, each kind for itself. On top, every
maximal run of key characters is a candidate: a window slides over it and the Shannon
entropy of its characters is kept up to date from the counts that one step changes. Windows
at or above the threshold of the candidate's character class are joined to spans of kind
``entropy``. What a pattern covers and what the allow list names (see ``allowed_parts``) is cut
out first, so it takes nothing else of its candidate with it; the rest is judged piece by piece.

Nothing is shuffled; a text is scanned whole, in linear time.

Defined results: a null text is an empty one and has no spans; repeated rows are scanned
each for itself; an empty table gives an empty one; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import bounded_batches

# The patterns. Letters of the keyword count in either case, ASCII only.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
# Allow list: public identifiers and content digests at their full length, in base64 or hexadecimal.
UUID = re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9A-Za-z])", re.I)
_SIZES = (("1", "27}=", 40), ("256", "43}=", 64), ("384", "64}", 96), ("512", "86}==", 128))
DIGEST = re.compile(
    r"(?<![0-9A-Za-z])(?:"
    + "|".join(f"sha{n}-(?:[A-Za-z0-9+/]{{{b}|[0-9a-f]{{{h}}})" for n, b, h in _SIZES)
    + r")(?![0-9A-Za-z+/=])"
)
# Placeholder words anywhere and standing for themselves, the start of a file path, and the host after "//".
PLACEHOLDER = re.compile(r"example|sample|placeholder|changeme|your[_-]|dummy|xxxx", re.I)
NAMED = re.compile(r"(?<![0-9A-Za-z])(?:(?:example|sample|placeholder)s?|changeme|your|dummy|x{4,})(?![0-9A-Za-z])", re.I)
PATH = re.compile(r"/[a-z][a-z_-]+/")
HOST = re.compile(r"//[a-z][a-z0-9_-]*(?=/|$)")
SEGMENT = re.compile(r"[^/]+")
SLASH = re.compile(r"/+")
NAME = re.compile(r"[-_=]*(?:(?:[A-Za-z]+|[0-9]{1,8})(?:[-_=]+|$))*")
KINDS = ("assign", "access", "hex", "entropy")

_HEX_ONLY = re.compile(r"[0-9a-fA-F]+")


@dataclass(frozen=True)
class Windows:
    """Window length and least entropy in bits, for hexadecimal and for other strings."""

    hex_size: int = 24
    hex_bits: float = 2.9
    text_size: int = 20
    text_bits: float = 3.8


_LOGS = [0.0] + [n * math.log2(n) for n in range(1, 257)]


def entropy_spans(value: str, size: int, bits: float) -> list[tuple[int, int]]:
    """Joined spans of all windows of ``size`` characters with at least ``bits`` of entropy.

    One step takes a character out and one in, so only two counts change.
    """
    if len(value) < size:
        return []
    counts: dict[str, int] = {}
    weight = 0.0
    for c in value[:size]:
        n = counts.get(c, 0)
        counts[c] = n + 1
        weight += _LOGS[n + 1] - _LOGS[n]
    most = size * (math.log2(size) - bits) + 1e-9
    spans: list[list[int]] = []
    for start in range(len(value) - size + 1):
        if start:
            n = counts[value[start - 1]]
            counts[value[start - 1]] = n - 1
            weight += _LOGS[n - 1] - _LOGS[n]
            n = counts.get(value[start + size - 1], 0)
            counts[value[start + size - 1]] = n + 1
            weight += _LOGS[n + 1] - _LOGS[n]
        if weight <= most:
            if spans and start <= spans[-1][1]:
                spans[-1][1] = start + size
            else:
                spans.append([start, start + size])
    return [(a, b) for a, b in spans]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the patterns, code points, end exclusive.

    The run of a key must not be cut short in the search of ``assign``: a match that is too
    short still uses up its text. For the other two kinds a short run holds no long one.
    """
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def allowed_parts(value: str) -> list[tuple[int, int]]:
    """Parts of a candidate that the allow list names.

    Those are whole UUIDs and digests, a host after ``//``, and segments (between slashes) of a file path or with a
    placeholder word standing for itself, if they are made like a name: of letters, or digits, between hyphens or
    underscores. A segment that mixes letters and digits is no name, however short, and is judged by its windows; in a path
    no window reaches over a slash.
    """
    parts = [m.span() for pattern in (UUID, DIGEST, HOST) for m in pattern.finditer(value)]
    path = PATH.match(value) is not None
    if path or NAMED.search(value):
        for m in SEGMENT.finditer(value):
            if NAME.fullmatch(m.group()) and (path or NAMED.search(m.group())):
                parts.append(m.span())
        if path:
            parts += [m.span() for m in SLASH.finditer(value)]
    return parts


def _pieces(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the parts taken leave of a range."""
    left = []
    for a, b in sorted(taken):
        if a > start:
            left.append((start, min(a, end)))
        start = max(start, b)
        if start >= end:
            return left
    return [*left, (start, end)]


def _windows_without_placeholder(value: str, size: int, bits: float) -> list[tuple[int, int]]:
    """Spans of the windows that hold no whole placeholder word, joined."""
    spans: list[tuple[int, int]] = []
    at = 0
    for first, last in [*(m.span() for m in PLACEHOLDER.finditer(value)), (len(value), len(value) + 1)]:
        for a, b in entropy_spans(value[at : last - 1], size, bits):
            if spans and at + a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], at + b))
            else:
                spans.append((at + a, at + b))
        at = first + 1
    return spans


def method_spans(text: str, base: list[tuple[int, int, str]], windows: Windows) -> list[tuple[int, int, str]]:
    """Spans of high entropy in what the patterns and the allow list leave of the candidates."""
    found = []
    least = min(windows.hex_size, windows.text_size)
    for m in CANDIDATE.finditer(text):
        taken = [(at + m.start(), end + m.start()) for at, end in allowed_parts(m.group())]
        taken += [(s, e) for s, e, _ in base if s < m.end() and m.start() < e]
        for at, end in _pieces(*m.span(), taken):
            value = text[at:end]
            if len(value) < least:
                continue
            if _HEX_ONLY.fullmatch(value):
                if value.isdigit():
                    continue
                size, bits = windows.hex_size, windows.hex_bits
            else:
                if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                    continue
                size, bits = windows.text_size, windows.text_bits
            found += [(at + a, at + b, "entropy") for a, b in _windows_without_placeholder(value, size, bits)]
    return found


def join_spans(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then kind in the order of ``KINDS``."""
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def scan(documents: DataFrame, windows: Windows = Windows(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, base spans and all spans (both joined texts) and the counts per kind."""
    bounded_batches(documents.sparkSession)
    chosen = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            base_texts, all_texts, digests = [], [], []
            for value in batch.column(1).to_pylist():
                base = base_spans(value or "")
                spans = base + method_spans(value or "", base, windows)
                for i, name in enumerate(KINDS):
                    counts[i].append(sum(s[2] == name for s in spans))
                base_texts.append(join_spans(base))
                digests.append(hashlib.sha256(base_texts[-1].encode()).hexdigest())
                all_texts.append(join_spans(spans))
            arrays = [pa.array(c, type=pa.int64()) for c in counts]
            arrays += [pa.array(c, type=pa.string()) for c in (base_texts, digests, all_texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[str(i) for i in range(8)])

    return chosen.mapInArrow(
        run,
        f"`{key}` {kind}, n_assign long, n_access long, n_hex long, n_entropy long, base_spans string, "
        "base_sha256 string, spans string",
    )
