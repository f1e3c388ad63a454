"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from parity import differences, duck

import __spark_entry__ as contract
from tarmac.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def brute(rows, anchor_every=100):
    usable = set()
    for vec_id, v, label in rows:
        if None in (vec_id, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        moved = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable.add((vec_id, moved, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for a in usable:
        if a[0] % anchor_every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2], strict=False)), b[0], b[1]) for b in usable if b != a)
        for p in [s for s in scored if s[2] == a[1]][:5]:
            inside = [s for s in scored if s[2] != a[1] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:10]
            out += [(a[0], p[1], r, n[1], -p[0], -n[0]) for r, n in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, hard_negatives.mine(df, **options).collect()))


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed, monkeypatch):
    """Also with many small groups, ties, copies, zero vectors and shorter vectors."""
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 60)
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        v = [round(rng.gauss(0.2, 1), seed + 1) for _ in range(6)]
        rows.append((i, v, rng.randrange(3 + 7 * seed)))
    rows += rows[:50]
    rows += [(600, [0.0] * 6, 1), (700, [1.0, 1.0], 1), (800, [-1.0] * 6, 2), (801, [], 1)]
    rows += [(1000 + i, [0.5] * 6, 1) for i in range(200)]
    assert mined(spark, rows, anchor_every=50) == brute(rows, 50)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 1.0], 2), (3, None, 2), (4, [nan, 1.0], 2)]
    rows += [(5, [inf, 1.0], 2), (6, [None, 1.0], 2), (8, [0.5, 1.0], None), (None, [0.5, 1.0], 2), (9, [1e30, 1.0], 3)]
    rows += [(100, [-1.0, -1.0], 1), (7, [0.6, 1.0], 2), (11, [0.4, 0.9], 5)]
    assert mined(spark, rows[:9] + rows[10:]) == brute(rows[:9] + rows[10:])
    assert len(mined(spark, rows)) > 0
    assert mined(spark, []) == []


def test_registered_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    df = contract.queries()["op13_hard_negatives"](spark, folder)
    assert not differences(df, duck(folder), contract.oracle_sql()["op13_hard_negatives"])


def test_lists_are_not_read_to_their_ends():
    rng = np.random.default_rng(3)
    rows = rng.integers(-100, 100, (20_000, 4))
    group = hard_negatives.Group(np.arange(20_000), np.arange(20_000), np.zeros(20_000, int), rows)
    scores = rows @ rows[0]
    (at, best), = group.best(rows[0], lambda at: at != 0, [hard_negatives.ANY_SCORE], 5)
    order = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i)[:5]
    assert [(-s, i) for s, i in zip(best.tolist(), at.tolist(), strict=True)] == order
    assert group.seen.mean() < 0.5
