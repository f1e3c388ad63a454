"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from tarmac.llm import spelling_variants as sv

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_words(rows, every=199):
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            yield run


def edits(w, letters):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
    out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    return out - {w}


def brute(words, least_length=6, least=5, times=5):
    n = {w: c for w, c in Counter(words).items() if len(w) >= least_length and c >= least}
    letters = {c for w in n for c in w}
    near = {w: [x for x in edits(w, letters) if x in n] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def test_registered_query_equals_brute_force(spark):
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    found = contract.queries()["op12_spelling_variants"](spark, FOLDER).collect()
    assert [f for f in found[0].__fields__] == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(brute_words(zip(table["doc_id"], table["text"], strict=True)))
    assert len(found) == len(want) and set(map(tuple, found)) == want
    assert any(r.form for r in found)


@pytest.mark.parametrize("block", [3, 40, 4096])
def test_many_alike_words_in_blocks_of_any_size(spark, documents, monkeypatch, block):
    """Groups far larger than a block, chains of forms, ties, words of one repeated letter and beyond ASCII."""
    monkeypatch.setattr(sv, "BLOCK", block)
    monkeypatch.setattr(sv, "CELLS", 500)
    rng = random.Random(block)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([4, 5, 5, 6]))) for _ in range(300)}
    words |= {"a" * k for k in range(1, 12)} | {"ababab" + c for c in "abcdef"}
    bag = [w for w in sorted(words) for _ in range(rng.choice([1, 2, 2, 10, 12, 60]))]
    bag += ["bbbbbbbb"] * 1500 + ["bbbbbbbé"] * 120 + ["bbbbbbéé"] * 6
    rng.shuffle(bag)
    rows = [(i, " ".join(bag[i * 50 : (i + 1) * 50]).upper()) for i in range(-(-len(bag) // 50))]
    rows = [(i, t.replace("É", "é")) for i, t in rows]
    found = sv.spelling_variants(documents(rows), least_length=3, least=2, every=7).collect()
    want = brute(brute_words(rows, 7), 3, 2)
    assert len(found) == len(want) and set(map(tuple, found)) == want
    assert any(r.form and r.root != r.form for r in found)


def test_odd_rows(spark, odd, documents):
    clash = odd.selectExpr("*", "'x' as word", "1 as n", "2 as length", "3 as h", "'r' as run", "'d' as doc")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = sv.spelling_variants(clash, least_length=2, least=2).collect()
    assert set(map(tuple, found)) == brute(brute_words(rows), 2, 2)
    assert sv.spelling_variants(documents([])).collect() == []
    long = "y" * 50_000
    twice = sv.spelling_variants(documents([(1, f"{long} {long}z"), (2, f"{long} {long}z")]), least=2, every=10**9).collect()
    assert sorted((len(r.word), r.n_near) for r in twice) == [(50_000, 1), (50_001, 1)]
