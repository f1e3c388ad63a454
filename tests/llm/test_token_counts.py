"""Token counts against the library on whole texts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from tarmac.llm import token_counts as tc
from tarmac.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tc._library(tokenizer_path())


def n_tokens(library, text):
    return len(library.encode(text or "", add_special_tokens=False))


def spliced(library, text, chunk, overlap):
    """Tokens of one text by chunks, None where some pair is not proven."""
    places = tc.cuts(text, chunk, overlap)
    parts = [library.encode(text[b:e], add_special_tokens=False) for b, e in places]
    total = sum(map(len, parts))
    for k in range(1, len(parts)):
        tail = tc._tokens(parts[k - 1], places[k - 1][0], places[k][0], None)
        head = tc._tokens(parts[k], places[k][0], places[k][0], places[k - 1][1])
        doubled = tc.doubled_tokens(tail, head, places[k - 1][1], places[k][0])
        if doubled is None:
            return None
        total -= doubled
    return total


PARTS = [
    "the quick brown fox ", "don't they'll we've I'm 's 't 'll", "x" * 40, "abc" * 15, "<|endoftext|>", "<|startoftext|>",
    "<|endoftext", "|>", "!!!???...", "'" * 30, "-=" * 20, "12345 6789 ", "\n\n\t   ", " " * 60, "été ", "é" * 10,
    "a" + "̣́" * 25, "\U0001f600\U0001f468‍\U0001f469", "한" * 12, "東京都は日本の首都です", "ΣΑΣ ΌΣΟΣ ",
    "≠≮", "İİ", "supercalifragilisticexpialidocious", "http://example.com/a?b=c&d=e ", "  ", "ﬁ ½ ㎏ ",
]


def test_splices_are_right_wherever_they_are_proven(library):
    rng = random.Random(11)
    proven = 0
    for k in range(4000):
        text = "".join(rng.choice(PARTS)[: rng.choice([3, 10, 99])] for _ in range(rng.randrange(8, 60)))
        chunk, overlap = [(64, 20), (96, 32), (128, 60)][k % 3]
        found = spliced(library, text, chunk, overlap)
        if found is not None:
            assert found == n_tokens(library, text), (text, chunk, overlap)
            proven += 1
    assert proven > 1500


def test_stretches_count_like_whole_texts(library):
    rng = random.Random(8)
    odd = [*PARTS, "a\x1cb\x1fc", "\x1c\x1d", "x\x85y", "p\u2028q\u3000r", "\u200bz", "\x0b\x0c\r", "\ufeffk", " \u0301e"]
    counter = tc.Counter(tokenizer_path())
    for _ in range(1500):
        text = "".join(rng.choice(odd) for _ in range(rng.randrange(1, 25)))
        assert counter.count([text]) == [n_tokens(library, text)], text


def test_chunks_cover_the_text_and_overlap():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["word ", "́" * 70, "x"]) for _ in range(200))
        places = tc.cuts(text, 64, 20)
        assert places[0][0] == 0 and places[-1][1] == len(text)
        for (a, b), (c, d) in zip(places, places[1:], strict=False):
            assert a < c <= b < d
        for (_, b), (c, _) in zip(places, places[2:], strict=False):
            assert b <= c


def test_registered_query_equals_the_library(spark, library):
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    found = {r.doc_id: tuple(r) for r in contract.queries()["op11_token_counts"](spark, FOLDER).collect()}
    want = {}
    for i, text in zip(table["doc_id"], table["text"], strict=True):
        n = n_tokens(library, text)
        want[i] = (i, len((text or "").encode()), n, n > 2048)
    assert found == want and any(len(t or "") > tc.CHUNK for t in table["text"])


def test_huge_odd_texts(spark, library, documents):
    """Chunks that never agree are widened up to the whole text; the other documents keep their chunks."""
    rng = random.Random(2)
    texts = ["x" * 5000, "abc" * 3000, " " * 4000, "a " + "́" * 3000, "'" * 3001, "", None, "short one"]
    texts += ["".join(rng.choice(PARTS) for _ in range(400)) for _ in range(20)]
    texts += ["xyz" * 700 + " " + "the end of it " * 300, "한" * 2000]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(3, texts[9], "en", "s"), (None, texts[9], "en", "s")]
    docs = documents(rows).selectExpr("*", "1 as row", "'p' as piece", "2 as n", "3 as n_bytes")
    out = tc.count_tokens(docs, tokenizer_path(), chunk=256, overlap=64).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    want = [(i, len((t or "").encode()), n_tokens(library, t), n_tokens(library, t) > 2048) for i, t, _, _ in rows]
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_odd_rows_and_empty_table(odd, documents, library):
    out = tc.count_tokens(odd, tokenizer_path()).collect()
    want = sorted(n_tokens(library, r.text) for r in odd.collect())
    assert sorted(r.n_tokens for r in out) == want and len(out) == 10
    assert tc.count_tokens(documents([]), tokenizer_path()).collect() == []
    assert tc.doubled_tokens(np.zeros((0, 6), np.int64), np.zeros((0, 6), np.int64), 10, 10) is None
