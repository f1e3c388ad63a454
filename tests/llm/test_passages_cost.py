"""Units are packed and compared before anything is stored of them, and a common one goes to its shard once from a block."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm import jaccard_join, passages
from tarmac.llm.words import mix


def prose(r, n):
    return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))


def test_units_that_do_not_repeat_are_not_stored(spark, documents, monkeypatch):
    r = random.Random(3)
    shared = prose(r, 40)
    texts = [prose(r, 400) for _ in range(40)] + [f"{prose(r, 50)} {shared} {prose(r, 50)}" for _ in range(2)]
    rows, keep = [], passages.keep

    def counted(df, *a):
        kept = keep(df, *a)
        rows.append(kept.count())
        return kept

    monkeypatch.setattr(passages, "keep", counted)
    found = passages.repeated_passages(documents(texts)).collect()
    assert {tuple(x) for x in found} == {(40, 50, 40, 40, False), (41, 50, 40, 40, True)}
    assert max(rows) <= 2 * len(texts)


def dealt(texts, shards, block, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", block)
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(i, i + 8), pa.int64()), pa.array(texts[i : i + 8])], ["row", "text"])
        for i in range(0, len(texts), 8)
    ]
    return list(passages._deal(shards)(iter(batches)))


@pytest.mark.parametrize("block", [1, 500, 10**6])
def test_repeated_units_of_all_shards(block, monkeypatch):
    r = random.Random(5)
    shared, common = [prose(r, 30) for _ in range(9)], prose(r, 20)
    texts = ["\n".join([prose(r, r.randrange(60)), r.choice(shared), common, prose(r, 9) + ". " + prose(r, 12)]) for _ in range(64)]
    text, place, kind, key = passages.units_of(pa.array(texts))
    rows = defaultdict(set)
    for t, k in zip(text.tolist(), key.tolist(), strict=True):
        rows[k].add(t)
    units = zip(text.tolist(), place.tolist(), kind.tolist(), key.tolist(), strict=True)
    want = sorted((t, p, n >> 1, k, n == 2 * passages.WINDOW) for t, p, n, k in units if len(rows[k]) > 1)
    parts = sorted((x for b in dealt(texts, 5, block, monkeypatch) for x in b.to_pylist()), key=lambda x: x["shard"])
    out = pa.Table.from_batches(passages._repeated(iter([pa.RecordBatch.from_pylist(parts[:7]), pa.RecordBatch.from_pylist(parts[7:])])))
    got = [(x["row"], x["first_word"], x["n_words"], x["key"] % 2**64, x["window"]) for x in out.to_pylist()]
    assert sorted(got) == want and len(want) > 64


def test_a_shard_gets_a_key_once_from_a_block(monkeypatch):
    common = prose(random.Random(6), 40)
    for batch in dealt([common] * 64, 5, 10**6, monkeypatch):
        for x in batch.to_pylist():
            keys = np.frombuffer(x["keys"], np.uint64)
            assert x["known"] or len(np.unique(keys)) == len(keys)


def test_touching_units_of_one_source_are_judged_as_one():
    r = random.Random(7)
    units = []
    for row in range(50):
        at = 0
        for _ in range(60):
            at += r.choice((0, 1, 3, 9, 9, 30))
            units.append((row, at, at + r.choice((5, 12, 12, 40)), r.choice((row, 60, 60, 60, 61)) if r.random() < 0.3 else 60))
    units.sort()
    want = []
    for row in range(50):
        own = [(a, b, first, first, first != row) for x, a, b, first in units if x == row]
        want += [(row, a, b - a, first if removed else row, removed) for a, b, first, removed in passages.passages_of(own)]
    columns = [pa.array(c, pa.int64()) for c in zip(*units, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, ["row", "first_word", "end", "first_row"])
    out = passages._judged(iter([batch.slice(0, 777), batch.slice(777)]))
    assert [tuple(x.values()) for b in out for x in b.to_pylist()] == want


def test_pairs_of_many_small_regions():
    r = np.random.default_rng(8)
    sets = []
    while len(sets) < 400:
        base = mix(r.integers(1, 2**60, r.integers(6, 200)).astype(np.uint64))
        for _ in range(r.integers(1, 9)):
            some = base.copy()
            some[r.random(len(base)) < r.choice((0, 0.05, 0.3))] += np.uint64(1)
            sets.append(np.unique(some))
    n = np.array([len(s) for s in sets])
    sketches = [jaccard_join.parity_sketch(s) for s in sets]
    comp, rank = r.integers(0, 300, len(n)), r.integers(0, 9, len(n)).astype(np.int32)
    size = []
    while sum(size) < len(n):
        size.append(min(int(r.integers(1, 12)), len(n) - sum(size)))
    starts = np.append(0, np.cumsum(size)[:-1])
    half = np.repeat(np.where(np.arange(len(size)) % 3, -1, 0), size)
    half[half == 0] = r.integers(0, 2, (half == 0).sum())
    want = set()
    for a, k in zip(starts.tolist(), size, strict=True):
        split = half[a : a + k] if half[a] >= 0 else None
        x, y = jaccard_join.region_pairs(n[a : a + k], comp[a : a + k], sketches[a : a + k], split)
        first = 9 * (rank[a + x] + rank[a + y]) <= n[a + x] + n[a + y]
        want |= {(min(p), max(p)) for p in zip((a + x[first]).tolist(), (a + y[first]).tolist(), strict=True)}
    x, y = jaccard_join._small_pairs(starts, np.array(size), n, comp, rank, half, sketches)
    assert {(min(p), max(p)) for p in zip(x.tolist(), y.tolist(), strict=True)} == want and len(want) > 50


@pytest.mark.parametrize("together", [1, 300, 1 << 17])
def test_sets_made_together(together, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TOGETHER", together)
    r = random.Random(9)
    texts = [None, "", " \n", *(" ".join(f"w{r.randrange(9)}" for _ in range(r.choice((1, 3, 4, 5, 6, 30, 400)))) for _ in range(90)), ""]
    words = jaccard_join.words_of(pa.array(texts))
    sets = [jaccard_join.shingle_set(words.hashes[words.of(i)]) for i in range(len(texts))]
    common = np.sort(np.unique(np.concatenate(sets))[::3])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    for late in (common, common[:0]):
        (out,) = jaccard_join._describe(late)(iter([batch]))
        for x, own in zip(out.to_pylist(), sets, strict=True):
            assert (x["n"], x["k1"], x["k2"]) == (len(own), *jaccard_join._fingerprint(own))
            assert x["sketch"] == jaccard_join.parity_sketch(own)
            in_order = np.concatenate([own[~np.isin(own, late)], own[np.isin(own, late)]])
            assert x["anchors"] == in_order[: jaccard_join.allowance(len(own))].view(np.int64).tolist()
    found = pa.Table.from_batches(jaccard_join._exact_sets(iter([batch]))).to_pylist()
    assert [(x["k1"], x["k2"], x["shingles"]) for x in found] == [(*jaccard_join._fingerprint(x), x.tobytes()) for x in sets]
