"""Large groups of near copies: how many pairs the join verifies."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tarmac.llm import jaccard_join
from tarmac.llm.words import SHINGLE

DOCS, WORDS = 500, 300


def near_copies() -> list[tuple[int, str]]:
    """Copies with two or four words replaced each: those with four are linked with the few that have two only."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(WORDS)]
    texts = []
    for doc in range(DOCS):
        words = list(base)
        for at in draw.sample(range(WORDS), 2 if doc % 10 == 5 else 4):
            words[at] = f"x{doc}_{at}"
        texts.append((doc, " ".join(words)))
    return texts


def brute_force(texts: list[tuple[int, str]]) -> dict[int, int]:
    sets = {}
    for doc, text in texts:
        words = text.split()
        sets[doc] = {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}
    root = {doc: doc for doc in sets}
    for a in sets:
        for b in range(a):
            common = len(sets[a] & sets[b])
            if root[a] != root[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((root[a], root[b]))
                root = {doc: low if r == high else r for doc, r in root.items()}
    return root


def test_pairs_grow_with_the_group_and_not_with_its_square(spark, monkeypatch):
    texts = near_copies()
    verified, counts = jaccard_join._verified, []

    def counted(docs, classes, pairs):
        counts.append(pairs.count())
        return verified(docs, classes, pairs)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = jaccard_join.jaccard_components(docs).select("doc_id", F.col("component_id"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute_force(texts)
    assert sum(counts) <= 3 * jaccard_join.PARTNERS * DOCS, counts
