from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from ledgerlake.llm import secret_scan as s


def plain_base(text):
    """The three patterns as the contract words them, short matches dropped afterwards."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), m.end(), "assign") for m in assign.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return spans + [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]


def test_base_spans_equal_the_plain_patterns():
    draw = random.Random(5)
    parts = ["Password", "token", "api_key", "SECRET", ": ", " = ", '"', "abc", "deadbeef" * 4, "AKIA", "ABCDEFGH1234", "é", "\n", " ", "ſecret"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(0, 12)))
        assert sorted(s.base_spans(text)) == sorted(plain_base(text)), text


def test_entropy_is_kept_up_to_date():
    draw = random.Random(6)
    for _ in range(300):
        value = "".join(draw.choice("ab01XYZ9_+"[: draw.choice([2, 5, 10])]) for _ in range(draw.randrange(0, 70)))
        size, bits = draw.choice([(8, 1.5), (20, 2.9), (12, 2.2)])
        covered = set()
        for i in range(len(value) - size + 1):
            counts = Counter(value[i : i + size])
            if -sum(c / size * math.log2(c / size) for c in counts.values()) >= bits - 1e-9:
                covered.update(range(i, i + size))
        got = {i for a, b in s.entropy_spans(value, size, bits) for i in range(a, b)}
        assert got == covered


def test_allow_list_and_base_suppress_entropy():
    random_key = "q7Zt9LmX2vKp4RwB8nYc5HdJ"
    assert s.method_spans(random_key, [], s.Windows())
    names = ("/usr/lib/python_modules/site-packages/some-long_module/2024-report", "my-example-of-a-long-placeholder/12345678-name")
    for text in ("123e4567-e89b-12d3-a456-426614174000", *names, "a" * 60, "internationalization"):
        assert s.method_spans(text, [], s.Windows()) == [], text
    text = "token=" + random_key
    assert s.method_spans(text, s.base_spans(text), s.Windows()) == []


def test_allow_list_takes_only_what_it_names():
    draw = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for size in (64, 400, 4000):
        for _ in range(60):
            value = "".join(draw.choice(letters) for _ in range(size))
            value = draw.choice(["", "/"]) + value[: size // 2] + draw.choice(["", "//", "xxxx", "Sample"]) + value[size // 2 :]
            covered = {i for a, b, _ in s.method_spans(value, [], s.Windows()) for i in range(a, b)}
            assert len(covered) >= 0.6 * len(value), value
    key = "q7Zt9LmX2vKp4RwB8nYc5HdJ"
    uuid, digest = "123e4567-e89b-12d3-a456-426614174000", "sha256-" + "q7Zt9LmX2vKp4RwB8nYc5HdJ3sFgT6uEaWx1Qo0iPlk" + "="
    for text in ("//user/" + key, "docs/examples/" + key, uuid + "/" + key, key + "/" + uuid, digest + "/" + key):
        spans = s.method_spans(text, [], s.Windows())
        assert len(spans) == 1 and key in text[spans[0][0] : spans[0][1]], (text, spans)
    assert s.method_spans(digest, [], s.Windows()) == []


@pytest.mark.parametrize("size", [20, 24, 38, 40, 41, 48, 64])
def test_keys_of_any_length_are_found_behind_paths_and_placeholders(size):
    draw = random.Random(size)
    for _ in range(40):
        key = "".join(draw.sample("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", min(size, 62))) + "a9" * (size == 64)
        key = "b7" + key[2:]
        for before in ("/secrets/", "/aws/", "/run/my-app/", "my-example-", "/usr/lib/x-y_z/"):
            for after in ("", "/next-page"):
                text = before + key + after
                spans = s.method_spans(text, [], s.Windows())
                assert spans and spans[0][0] <= len(before) + 1 and max(e for _, e, _ in spans) >= len(before) + size - 1, (text, spans)
                if before.startswith("/"):  # no window reaches over a slash of a path
                    assert all(len(before) <= a and e <= len(before) + size for a, e, _ in spans)


def test_base_span_takes_only_its_own_part():
    key = "q7Zt9LmX2vKp4RwB8nYc5HdJ"
    text = "AKIA" + "ABCDEFGH12345678" + "/" + key
    base = s.base_spans(text)
    assert base == [(0, 20, "access")]
    assert s.method_spans(text, base, s.Windows()) == [(20, len(text), "entropy")]


def test_rows(spark, odd, nothing):
    frame = odd.select("doc_id", "text").unionAll(spark.createDataFrame([(99, 'é "token": "abcdefgh" AKIA' + "A" * 12)], "doc_id long, text string"))
    rows = s.scan(frame).collect()
    assert len(rows) == frame.count()
    one = next(r for r in rows if r.doc_id == 99)
    assert one.base_spans == "assign:3:20,access:22:38" and (one.n_assign, one.n_access, one.n_hex) == (1, 1, 0)
    assert one.base_sha256 == hashlib.sha256(one.base_spans.encode()).hexdigest()
    assert {r.spans for r in rows if r.doc_id in (4, 5, 6)} == {""}
    assert s.scan(nothing).collect() == []
