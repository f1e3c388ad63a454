"""Hard negatives by the threshold algorithm over per-dimension sorted lists.

All vectors are dealt into groups by hash. A task holds one group, keeps for every dimension the list of its rows sorted
by that component, and lets the anchors stream past. For an anchor it reads the lists in parallel, each from the end that
the sign of the anchor's component asks for (sorted access), scores every row met for the first time by its whole integer
inner product (random access), and knows that no row still unseen can score above the threshold: the sum over
dimensions of the anchor's component times the last value read. It stops once the threshold is strictly below the kth
score of every window, or below a window's lower end where fewer than k rows are in it. Best rows of all groups
are merged by a row number, which Spark cuts per input partition before its shuffle.

This runs twice over the stored groups: for the positives (one window of any score over rows of the anchor's label), then
for the negatives (a window per positive over rows of other labels). Anchors meet all rows group by group; nothing
is broadcast, no label or vector gathers in one task, and a group has at most ``GROUP_ROWS`` rows on average.

Rows with a null label, null vector or a null or non-finite component take no part, nor do rows without a
``vec_id``. Rows equal in vec_id, label and vector count once; rows that share only the vec_id are rows of their
own, in the order of their vectors' hashes. Components beyond 2**28 after scaling count as 2**28. Missing
trailing components of a shorter vector count as 0. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.store import keep, release, setup

SCALE = 256
LARGEST = 1 << 28
# Rows of a group: a multiple of the root of all rows, so that groups and anchors per group grow alike, up to a bound.
GROUP_ROWS = 1 << 18
ROOT_FACTOR = 16
FIRST_DEPTH = 16


def quantised(vectors: DataFrame, relabel_every: int, labels: int) -> DataFrame:
    """Rows (key, vec_id, label, v) that take part, each once; ``key`` names the row."""
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    )
    moved = F.pmod("vec_id", F.lit(relabel_every)) == 0
    label = F.col("label").cast("long")
    whole = F.transform(
        "embedding",
        lambda x: F.greatest(
            F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), F.floor(x.cast("double") * SCALE).cast("double"))
        ).cast("int"),
    )
    rows = vectors.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(moved, (label + 1) % labels).otherwise(label).alias("label"),
        whole.alias("v"),
    )
    return rows.distinct().select(F.xxhash64("vec_id", "label", "v").alias("key"), "*")


class Group:
    """The rows of one group with a sorted list per dimension."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.keys, self.ids, self.labels, self.rows = keys, ids, labels, rows
        columns = np.ascontiguousarray(rows.T)
        self.order = np.argsort(columns, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(columns, self.order.astype(np.int64), axis=1)
        self.seen = np.zeros(len(ids), bool)
        largest = int(np.abs(rows).max(initial=0))
        # Sums of products below 2**53 are exact in doubles, whose products are faster.
        self.exact_below = (1 << 53) // max(1, largest * max(1, rows.shape[1]))
        self.doubles = rows.astype(np.float64)

    def scores(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        if int(np.abs(anchor).max(initial=0)) < self.exact_below:
            return (self.doubles[at] @ anchor.astype(np.float64)).astype(np.int64)
        return self.rows[at] @ anchor

    def best(
        self, anchor: np.ndarray, takes: Callable[[np.ndarray], np.ndarray], windows: list[tuple[int, int]], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (lowest, highest score) the rows and scores of its first k among the rows that ``takes`` admits."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        self.seen[:] = False
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, depth = 0, FIRST_DEPTH
        while True:
            depth = min(depth, n)
            met = np.zeros(n, bool)
            met[self.order[up, n - depth : n - done]] = True
            met[self.order[down, done:depth]] = True
            if depth == n:
                met[:] = True  # an anchor of zeros has no list to read
            met &= ~self.seen
            self.seen |= met
            fresh = np.flatnonzero(met)
            fresh = fresh[takes(fresh)]
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, self.scores(anchor, fresh)])
            if depth == n:
                break
            threshold = int(anchor[up] @ self.sorted[up, n - depth]) + int(anchor[down] @ self.sorted[down, depth - 1])
            ranked = np.sort(scores)
            if all(threshold < self._least(ranked, low, high, k) for low, high in windows):
                break
            done, depth = depth, 2 * depth
        found = []
        for low, high in windows:
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            order = np.lexsort((self.keys[rows[inside]], self.ids[rows[inside]], -scores[inside]))[:k]
            found.append((rows[inside[order]], scores[inside[order]]))
        return found

    @staticmethod
    def _least(ranked: np.ndarray, low: int, high: int, k: int) -> int:
        """The score below which no row can enter the window's first k."""
        first, end = np.searchsorted(ranked, low, "left"), np.searchsorted(ranked, high, "right")
        return int(ranked[end - k]) if end - first >= k else low


ANY_SCORE = (-(1 << 63) + 1, (1 << 63) - 1)
FOUND = "anchor long, place int, key long, vec_id long, score long"


def window_of(score: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """Integer scores s with low_percent * score <= 100 * s <= high_percent * score."""
    return -(-low_percent * score // 100), high_percent * score // 100


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """One row per vector; shorter ones are filled with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy().astype(np.int64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _group(batches: list[pa.RecordBatch]) -> Group:
    tables = pa.Table.from_batches(batches).combine_chunks()
    columns = (tables.column(c).to_numpy().astype(np.int64) for c in ("key", "vec_id", "label"))
    return Group(*columns, _matrix(tables.column("v").chunk(0)))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Stretches of one part and one kind of row."""
    part = batch.column("part").to_numpy()
    kind = batch.column("is_anchor").to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(part)], strict=True):
        if a < b:
            yield int(part[a]), bool(kind[a]), batch.slice(a, b - a)


def _search(k: int, same_label: bool, low_percent: int, high_percent: int):
    """Rows sorted by (part, is anchor) to the best rows of every part for every anchor."""

    def ask(group: Group, row: dict, vector: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        anchor = np.zeros(group.rows.shape[1], np.int64)
        anchor[: len(vector)] = vector[: len(anchor)]
        if same_label:
            places, windows = [0], [ANY_SCORE]
        else:
            every = [(p, window_of(s, low_percent, high_percent)) for p, s in enumerate(row["scores"])]
            places = [p for p, (low, high) in every if low <= high]
            windows = [w for _, w in every if w[0] <= w[1]]

        def takes(at: np.ndarray) -> np.ndarray:
            if same_label:
                return (group.labels[at] == row["label"]) & (group.keys[at] != row["key"])
            return group.labels[at] != row["label"]

        if windows:
            for place, (at, scores) in zip(places, group.best(anchor, takes, windows, k), strict=True):
                yield place, at, scores

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, waiting = None, None, []
        for batch in batches:
            found: list[list[np.ndarray]] = [[] for _ in range(5)]
            for where, is_anchor, some in _runs(batch):
                if where != part:
                    part, group, waiting = where, None, []
                if not is_anchor:
                    waiting.append(some)
                    continue
                if waiting:
                    group, waiting = _group(waiting), []
                if group is None:
                    continue  # a part without rows
                for row, vector in zip(some.drop_columns("v").to_pylist(), _matrix(some.column("v")), strict=True):
                    for place, at, scores in ask(group, row, vector):
                        columns = np.full(len(at), row["key"]), np.full(len(at), place), group.keys[at], group.ids[at], scores
                        for held, column in zip(found, columns, strict=True):
                            held.append(column)
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]
            flat[1] = flat[1].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in flat], ["anchor", "place", "key", "vec_id", "score"])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k rows per anchor and place, with ``rank`` from 1."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    *,
    anchor_every: int = 100,
    relabel_every: int = 7,
    labels: int = 10,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """For each anchor (vec_id divisible by ``anchor_every``) and each of its best ``positives`` rows of the same label,
    the best ``negatives`` rows of other labels whose score is between the two percentages of the positive's."""
    setup(vectors.sparkSession)
    rows = keep(quantised(vectors, relabel_every, labels))
    count = rows.count()
    size = min(GROUP_ROWS, max(1024, int(ROOT_FACTOR * count**0.5)))
    parts = max(1, -(-count // size))
    anchors = rows.where(F.pmod("vec_id", F.lit(anchor_every)) == 0)

    def scan(some: DataFrame, k: int, same_label: bool) -> DataFrame:
        none = F.lit(None).cast("array<bigint>")
        part = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
        held = rows.select(part.alias("part"), F.lit(False).alias("is_anchor"), "*", none.alias("scores"))
        every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        asked = some.select(every.alias("part"), F.lit(True).alias("is_anchor"), "key", "vec_id", "label", "v", "scores")
        dealt = held.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "is_anchor")
        return dealt.mapInArrow(_search(k, same_label, low_percent, high_percent), FOUND)

    without = anchors.withColumn("scores", F.lit(None).cast("array<bigint>"))
    near = keep(_first(scan(without, positives, True), positives))
    # At most ``positives`` entries each, in the order of their ranks.
    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("near"))
    asked = keep(anchors.join(lists, F.col("key") == F.col("anchor")).drop("anchor"))
    with_scores = asked.select("key", "vec_id", "label", "v", F.col("near.score").alias("scores"))
    far = keep(_first(scan(with_scores, negatives, False), negatives))
    release(rows, near)
    names = asked.select(
        F.col("key").alias("anchor"),
        F.col("vec_id").alias("anchor_id"),
        F.posexplode("near").alias("place", "positive"),
    )
    return far.join(names, ["anchor", "place"]).select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


ORACLE = """
WITH usable AS (
    SELECT DISTINCT vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
    s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p
JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
