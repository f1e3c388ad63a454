"""What one shard and one block of op10 hold does not grow with the corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from tarmac.llm import kneser_ney, store


def test_bigrams_of_text_begins_are_spread_over_shards(spark, documents, monkeypatch):
    docs = documents([f"only{i} word" if i % 2 else f"only{i}" for i in range(400)])
    usual = {str(r) for r in kneser_ney.score_documents(docs).collect()}
    asked = []
    outgoing = kneser_ney._outgoing
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 100)
    monkeypatch.setattr(kneser_ney, "_outgoing", lambda *a: asked.append(a) or outgoing(*a))
    assert {str(r) for r in kneser_ney.score_documents(docs).collect()} == usual
    (shards, spread), *_ = asked
    assert shards >= 8
    words = np.arange(1, 2001, dtype=np.uint64)
    blocks = kneser_ney._block([*range(2000)], [False] * 2000, [words[i : i + 1] for i in range(2000)]).to_pydict()
    block = kneser_ney.Block(*(blocks[c][0] for c in ("ends", "held", "vocabulary", "tokens")))
    *_, shard, _, _ = block.bigrams(shards, spread)
    assert len(shard) == 2000
    assert np.bincount(shard).max() < 2 * 2000 / shards


def test_a_shard_is_added_up_as_by_hand():
    rng = np.random.default_rng(5)
    sent, want = [], {}
    for blk in range(9):
        pairs = np.unique(rng.integers(1, 30, (200, 2)).astype(np.uint64), axis=0)
        count = rng.integers(0, 3, len(pairs)).astype(np.uint32)
        runs = np.append(np.flatnonzero(np.diff(pairs[:, 0].astype(np.int64), prepend=-1)), len(pairs))
        planes = [kneser_ney._planes(x) for x in (np.diff(runs).astype(np.uint32), count)]
        first, second = pairs[runs[:-1], 0].tobytes(), pairs[:, 1].tobytes()
        sent.append({"blk": blk, "shard": 0, "firsts": first, "runs": planes[0], "seconds": second, "counts": planes[1]})
        for (u, w), c in zip(pairs.tolist(), count.tolist(), strict=True):
            want[u, w] = want.get((u, w), 0) + c
    merged = kneser_ney._merge(pa.Table.from_pylist(sent)).to_pylist()
    for row, asked in zip(merged, sent, strict=False):
        pairs = zip(
            np.repeat(np.frombuffer(asked["firsts"], np.uint64), kneser_ney._from_planes(asked["runs"], np.uint32)).tolist(),
            np.frombuffer(asked["seconds"], np.uint64).tolist(),
            strict=True,
        )
        assert kneser_ney._from_planes(row["counts"], np.uint32).tolist() == [want[p] for p in pairs]
    seen = {p: c for p, c in want.items() if c}
    stats = {r["word"]: r for r in merged[len(sent) :]}
    assert stats.keys() == {None, *(x for p in seen for x in p)}
    assert stats[None]["cont"] == len(seen) and stats[None]["n1"] == sum(c == 1 for c in seen.values())
    for word in (1, 7, 29):
        own = [c for (u, _), c in seen.items() if u == word]
        assert (stats[word]["ctx"], stats[word]["n2"], stats[word]["n3"]) == (sum(own), own.count(2), sum(c > 2 for c in own))
        assert stats[word]["cont"] == sum(w == word for _, w in seen)


def test_wide_rows_are_stored_a_few_at_a_time(spark):
    rows = spark.range(24, numPartitions=1).selectExpr("id", "repeat(sha2(cast(id as string), 256), 20000) as wide")
    kept = store.keep(rows, wide=True)
    (file,) = kept.inputFiles()
    groups = pq.ParquetFile(file.removeprefix("file:")).metadata
    assert kept.distinct().count() == 24
    assert max(groups.row_group(i).num_rows for i in range(groups.num_row_groups)) <= store.WIDE_ROWS
    store.release(kept)
