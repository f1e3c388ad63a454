"""Benchmark passages in documents, found by spaced seeds and verified with substitutions allowed.

A seed is the hash of six words at the positions of a fixed mask; positions that a mask leaves out may differ. Seeds of
documents are joined with seeds of benchmark items. A bitmap of fixed size (``BITMAP_BITS``), made from the benchmark's seeds and
shipped to the workers, drops document seeds that cannot match; what it lets through wrongly the join drops. Around each hit
the words of document and item are compared along the hit's diagonal; the best stretch counts
1 per equal word and -4 per different one, so at least four words in five agree. It is reported from
``LEAST_WORDS`` equal words on, or from four fifths of the item if that is shorter; else (with ``whole``,
as the query and the pipeline have it), if at least four words in five of the whole item agree along the diagonal, from the first to the last of them. An item of fewer than
six words is found where all its words are.

Nulls and empty texts match nothing. Several items of equal text give a row each.
A doc_id that repeats is reported once per item. Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import keep, setup
from tarmac.llm.words import mix, windows, words_of

# Fixed masks: the word positions that a seed looks at.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 6, 8), (0, 1, 4, 5, 8, 9))
# Items of fewer words have a seed of all their words.
SHORT = 6
LEAST_WORDS = 12
PENALTY = 4
BITMAP_BITS = 24
_U = np.uint64


def _seeds(hashes: np.ndarray, sizes: list[int]) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Masks and their seeds; ``sizes``: those of the short items."""
    for k, mask in [*enumerate(MASKS), *((len(MASKS) + n, tuple(range(n))) for n in sizes)]:
        yield mask, mix(windows(hashes, list(mask)) + _U(k))


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = words_of(batch.column("text"))
        for i, item in enumerate(batch.column("item").to_pylist()):
            own = words.hashes[words.of(i)]
            short = len(own) < SHORT
            for _, seeds in _seeds(own, [len(own)] if 0 < len(own) < SHORT else []):
                n = len(seeds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds.view(np.int64)), pa.array([item] * n, pa.int64()), pa.array(np.arange(n)), pa.array([short] * n, pa.bool_())],
                    ["seed", "item", "at", "short"],
                )


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = words_of(batch.column("text"))
        rows = [words.hashes[words.of(i)] for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item"),
                batch.column("item_id"),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([r.tobytes() for r in rows], pa.binary()),
            ],
            ["item", "item_id", "size", "item_words"],
        )


def _bits(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = _U((1 << BITMAP_BITS) - 1)
    return (seeds & mask).astype(np.int64), ((seeds >> _U(32)) & mask).astype(np.int64)


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bytes of the bitmap with two bits set per seed; its size does not depend on the benchmark."""
    mask = (1 << BITMAP_BITS) - 1
    both = F.array(
        F.col("seed").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(mask))
    )
    bits = seeds.select(F.explode(both).alias("b"))
    parts = (
        bits.groupBy(F.floor(F.col("b") / 32768).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("b") % 32768).alias("bits"))
        .collect()
    )
    table = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for row in parts:
        table[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return table


RUNS = "doc_id long, start long, words binary, at array<long>, seeds array<long>"


def _document_runs(bitmap: np.ndarray, longest: int, sizes: list[int]):
    def maybe(seeds: np.ndarray) -> np.ndarray:
        first, second = _bits(seeds)
        found = np.flatnonzero((bitmap[first >> 3] >> (first & 7).astype(np.uint8)) & 1)
        second = second[found]
        return found[((bitmap[second >> 3] >> (second & 7).astype(np.uint8)) & 1).astype(bool)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column("text"))
            position = np.arange(len(words.hashes))
            last = np.repeat(words.ptr[1:], np.diff(words.ptr))  # end of the text of each word
            hits, seeds = [], []
            for mask, every in _seeds(words.hashes, sizes):
                n = len(every)
                found = maybe(every)
                found = found[position[:n][found] + mask[-1] < last[:n][found]]
                hits.append(found)
                seeds.append(every[found])
            at, seed = np.concatenate(hits), np.concatenate(seeds)
            order = np.argsort(at, kind="stable")
            at, seed = at[order], seed[order]
            doc = np.searchsorted(words.ptr, at, side="right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(doc) != 0) | (np.diff(at) > longest)
            cuts = np.append(np.flatnonzero(new), len(at))
            ids = batch.column("doc_id")
            rows: list[list] = [[], [], [], [], []]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                d = doc[a]
                low = max(words.ptr[d], at[a] - longest)
                high = min(words.ptr[d + 1], at[b - 1] + longest + 1)
                rows[0].append(ids[int(d)].as_py())
                rows[1].append(int(low - words.ptr[d]))
                rows[2].append(words.hashes[low:high].tobytes())
                rows[3].append(at[a:b] - low)
                rows[4].append(seed[a:b].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[0], pa.int64()),
                    pa.array(rows[1], pa.int64()),
                    pa.array(rows[2], pa.binary()),
                    pa.array(rows[3], pa.list_(pa.int64())),
                    pa.array(rows[4], pa.list_(pa.int64())),
                ],
                ["doc_id", "start", "words", "at", "seeds"],
            )

    return run


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(begin, end, equal words) of the stretch with the highest score."""
    sums = np.append(0, np.cumsum(np.where(equal, 1, -PENALTY)))
    gain = sums - np.minimum.accumulate(sums)
    end = int(gain.argmax())
    begin = int(sums[: end + 1].argmin())
    return begin, end, int(equal[begin:end].sum())


FOUND = "doc_id long, item_id long, first_word long, n_words long, n_equal long"


def _verify(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, item = np.frombuffer(r["words"], _U), np.frombuffer(r["item_words"], _U)
                low, high = max(0, -r["shift"]), min(len(item), len(text) - r["shift"])
                begin, end, equal = best_stretch(item[low:high] == text[low + r["shift"] : high + r["shift"]])
                need = -(-4 * len(item) // 5)
                if len(item) < SHORT or (whole and equal < min(LEAST_WORDS, need)):  # then by the item as a whole
                    same = np.flatnonzero(item[low:high] == text[low + r["shift"] : high + r["shift"]])
                    if len(same) < (len(item) if len(item) < SHORT else need):
                        continue
                    begin, end, equal = int(same[0]), int(same[-1]) + 1, len(same)
                if equal >= min(LEAST_WORDS, need):
                    first = r["start"] + r["shift"] + low + begin
                    rows.append((r["doc_id"], r["item_id"], first, end - begin, equal))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "first_word", "n_words", "n_equal"]
            )

    return run


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, whole: bool = False) -> DataFrame:
    """The best overlap of each document with each benchmark item it contains a passage of (see ``FOUND``).

    ``whole``: items that agree in four words of five are found too where no stretch is good enough.
    """
    setup(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = keep(items.withColumn("item", F.monotonically_increasing_id()))
    seeds = keep(items.mapInArrow(_item_seeds, "seed long, item long, at long, short boolean"))
    spelled = keep(items.mapInArrow(_item_words, "item long, item_id long, size long, item_words binary"))
    longest = spelled.agg(F.coalesce(F.max("size"), F.lit(0))).head()[0]

    sizes = [r["size"] for r in spelled.where(f"size > 0 and size < {SHORT}").select("size").distinct().collect()]

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = texts.mapInArrow(_document_runs(_bitmap(seeds), longest, sizes), RUNS)
    runs = keep(runs.withColumn("run", F.monotonically_increasing_id()))
    hits = runs.select("run", F.inline(F.arrays_zip(F.col("at").alias("pos"), F.col("seeds").alias("seed"))))
    hits = hits.toDF("run", "pos", "seed").join(seeds, "seed")
    shift = F.col("pos") - F.col("at")
    # A short item is there as a whole, so one place of a run does.
    hits = hits.groupBy("run", "item", F.when(~F.col("short"), shift).alias("place")).agg(F.min(shift).alias("shift"))
    hits = keep(hits.drop("place"))
    both = hits.join(runs.select("run", "doc_id", "start", "words"), "run").join(spelled, "item")
    both = both.select("doc_id", "start", "words", "item_id", "item_words", "shift")
    found = both.mapInArrow(_verify(whole), FOUND)
    best = F.max(F.struct("n_equal", "n_words", -F.col("first_word"))).alias("b")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "item_id",
            (-F.col("b.col3")).alias("first_word"),
            F.col("b.n_words").alias("n_words"),
            F.col("b.n_equal").alias("n_equal"),
        )
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no passage of the benchmark; a repeated doc_id is judged as a whole."""
    found = keep(benchmark_overlaps(docs, benchmark, whole=True).select(F.col("doc_id").alias("bad")).distinct())
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("bad")), "left_anti")
