"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import (
    crf_pii,
    jaccard_join,
    kneser_ney,
    language_mixture,
    passages,
    quartile_digest,
    secret_owners,
    spaced_seeds,
    tool_links,
    trie_bpe,
)
from tarmac.llm.queries import tokenizer_path

PER_ROW = {
    "op1": quartile_digest.compare_with_next,
    "op3": crf_pii.personal_data,
    "op4": lambda docs: trie_bpe.encode_documents(docs, tokenizer_path()),
    "op7": jaccard_join.jaccard_components,
    "op8": secret_owners.owned_secrets,
    "op9": language_mixture.predict_languages,
    "op10": kneser_ney.score_documents,
}


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_every_row(odd, name):
    clash = odd.select("*", *[F.lit("x").alias(c) for c in ("n", "row", "k1", "spans", "blk", "fingerprint")])
    rows = PER_ROW[name](clash).collect()
    assert len(rows) == 10
    assert sorted(r.doc_id or -1 for r in rows) == [-1, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    twice = [r for r in rows if r.doc_id == 5]
    if name != "op1":  # the successors of repeated rows differ
        assert twice[0] == twice[1]


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(documents, name):
    assert PER_ROW[name](documents([])).collect() == []


def test_pairs_on_odd_rows(spark, odd, documents):
    items = bench(spark, [(1, None), (2, ""), (3, "one two three"), (4, "same text twice in the table here")])
    found = spaced_seeds.benchmark_overlaps(odd, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(5, 4), (6, 4)}
    assert spaced_seeds.benchmark_overlaps(documents([]), bench(spark, [])).collect() == []
    assert spaced_seeds.without_benchmark(odd, items).count() == 7
    assert passages.repeated_passages(odd).collect() == []
    assert passages.repeated_passages(documents([])).collect() == []


def test_tool_links_on_odd_rows(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", None, 0, "search", '{"query": "x"}'),
            (1, "a", None, 3, "search", "{"),
            (1, "b", "a", 1, "lookup", '{"limit": "1", "query": "x", "more": 1}'),
            (1, "c", "gone", 2, "fly", None),
            (1, "d", "e", 3, "search", "[1]"),
            (1, "e", "d", 4, "search", '{"query": 5}'),
            (None, "a", None, 0, "search", "{}"),
            (2, None, None, 0, "search", "{}"),
        ],
        "conv_id long, call_id string, after string, turn long, name string, arguments string",
    )
    results = spark.createDataFrame(
        [(1, "a", 5, "late"), (1, "a", 4, "early"), (1, "zz", 1, "orphan")],
        "conv_id long, call_id string, turn long, content string",
    )
    out = {r.call_id: r for r in tool_links.link_tools(calls, results, tool_links.tools(spark)).collect()}
    assert set(out) == {"a", "b", "c", "d", "e", "zz"}
    orphan = out["zz"]
    assert (orphan.errors, orphan.valid, orphan.copies, orphan.answers, orphan.turn) == ("result without a call", False, 0, 1, 1)
    assert '"result":"orphan"' in orphan.json
    assert out["a"].valid and out["a"].copies == 2 and out["a"].answers == 2 and out["a"].depth == 0
    assert '"result":"early"' in out["a"].json and out["a"].json.startswith('{"arguments":{"query":"x"}')
    assert out["b"].depth == 1 and out["b"].errors == "type of limit; unknown more"
    assert out["c"].missing and out["c"].depth == 0 and out["c"].errors == "no such tool"
    assert out["d"].depth is None and out["d"].errors == "not an object"
    assert out["e"].depth is None and out["e"].errors == "type of query"


def test_long_chains_are_ordered(spark):
    calls = spark.range(300).selectExpr(
        "1L as conv_id", "concat('c', id) as call_id", "if(id = 0, null, concat('c', id - 1)) as after",
        "id as turn", "'search' as name", "'{}' as arguments",
    )
    depths = tool_links.depths(calls).collect()
    assert all(r.depth == int(r.call_id[1:]) for r in depths)


def test_stages_on_odd_rows(spark, odd, documents, tmp_path):
    bench(spark, [(1, "same text twice in the table here")]).write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, documents([])):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            if name != "tokens":
                assert docs.columns == odd.columns
        rows = docs.collect()
    assert rows == []
