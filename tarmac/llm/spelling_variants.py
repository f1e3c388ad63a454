"""Spelling variants: words one insertion, deletion or replacement apart, and the frequent form each one leads to.

Words are counted in Spark from whole texts. Two words are near when the lengths of their common prefix and their
common suffix together reach the longer length less one. That is evaluated densely: a tile holds two blocks of
words as matrices of code points, padded on the right for prefixes and on the left for suffixes, and compares row
against row in stretches of bounded size.

Which blocks form a tile follows from the same fact. A single edit lies in the first or in the second half of the
word, so near words share either their first or their last ``length // 2`` code points (of the shorter word). Blocks
are therefore built per length and half: a word enters as the shorter one under its own length and as the longer one under
the length below, once by prefix and once by suffix. A half shared by very many words is dealt into blocks of
``BLOCK`` words by hash, and pairs of blocks meet as rows of arrays, so that no task holds more than two blocks. A pair
that shares both halves is reported by its prefix alone. Tiles report per word only the number of near words and
the best of them, which Spark adds up.

Null texts have no words. A null ``doc_id`` reads as empty text in ``altered_words``. Repeated rows count again. Very
long runs of letters are words like others; their tiles are compared in correspondingly shorter stretches. Columns other
than doc_id and text are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import keep, mark, release_since, setup

RUN = "[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of a block on average, and cells of a dense comparison.
BLOCK = 2048
CELLS = 1 << 21


def altered_words(docs: DataFrame, every: int = 199) -> DataFrame:
    """Column ``word``: lower-cased runs; where ``every`` divides the checksum of ``doc_id:run``, one letter is left out."""
    run = F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    rows = rows.select("doc", F.translate("run", CAPITALS, SMALL).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.pmod("h", F.lit(every)) == 0, cut).otherwise(F.col("run")).alias("word"))


def frequent_words(words: DataFrame, least_length: int = 6, least: int = 5) -> DataFrame:
    """Rows (word, n) of the words that are long and frequent enough."""
    long_enough = words.where(F.length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _matrix(words: list[str], sizes: np.ndarray, width: int, flush_right: bool) -> np.ndarray:
    """Code points of each word as a row of ``width`` numbers, padded with 0."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    place = np.arange(width)
    inside = place >= (width - sizes)[:, None] if flush_right else place < sizes[:, None]
    out = np.zeros((len(words), width), np.uint8 if flat.max(initial=0) < 256 else np.uint32)
    out[inside] = flat
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of the rows of two matrices of equal shape."""
    apart = a != b
    return np.where(apart.any(axis=1), apart.argmax(axis=1), a.shape[1])


def _stretches(partners: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive words with about ``limit`` pairs together."""
    total = np.cumsum(partners)
    first = 0
    while first < len(total):
        before = total[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(total, before + limit, "right")))
        yield slice(first, end)
        first = end


def near_pairs(
    words: list[str], first: np.ndarray, partners: np.ndarray, length: int, by_suffix: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of near words, of which the shorter one has ``length`` code points.

    Word i is compared with the ``partners[i]`` words from position ``first[i]`` on. With ``by_suffix`` pairs
    that also share their first halves are left out.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = length + 1
    heads = _matrix(words, sizes, width, False)
    tails = np.ascontiguousarray(_matrix(words, sizes, width, True)[:, ::-1])
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for some in _stretches(partners, max(1, CELLS // width)):
        count = partners[some]
        i = np.repeat(np.arange(some.start, some.start + len(count)), count)
        j = np.repeat(first[some] - (np.cumsum(count) - count), count) + np.arange(len(i))
        # Two longer words meet under their own length.
        fits = np.minimum(sizes[i], sizes[j]) == length
        i, j = i[fits], j[fits]
        # A half in common leaves the other end to look at, and most pairs differ there at once.
        prefix = np.minimum(_common(heads[i], heads[j]), length)
        suffix = np.minimum(_common(tails[i], tails[j]), length)
        near = prefix + suffix >= np.maximum(sizes[i], sizes[j]) - 1
        if by_suffix:
            near &= prefix < length // 2
        found_a.append(i[near])
        found_b.append(j[near])
    return np.concatenate(found_a), np.concatenate(found_b)


def _best(words: list[str], counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Per word its number of near words, and the most frequent of them."""
    own, other = np.concatenate([i, j]), np.concatenate([j, i])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[other], -counts[other], own))
    own, other = own[order], other[order]
    at = np.flatnonzero(np.diff(own, prepend=-1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[x] for x in own[at].tolist()], pa.string()),
            pa.array(np.diff(at, append=len(own)), pa.int64()),
            pa.array([words[x] for x in other[at].tolist()], pa.string()),
            pa.array(counts[other[at]], pa.int64()),
        ],
        ["word", "n_near", "other", "other_n"],
    )


TILE = "word string, n_near long, other string, other_n long"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (length, by_suffix, left, right) to what each tile knows of its words; ``right`` is null within one block."""
    for batch in batches:
        kinds: dict[tuple[int, bool], list[tuple[list, list | None]]] = {}
        for row in batch.to_pylist():
            kinds.setdefault((row["length"], row["by_suffix"]), []).append((row["left"], row["right"]))
        for (length, by_suffix), tiles in kinds.items():
            words: list[str] = []
            counts: list[int] = []
            first: list[int] = []
            partners: list[int] = []
            for left, right in tiles:
                if right is None:
                    left.sort(key=lambda x: len(x["word"]))
                    shorter = sum(len(x["word"]) == length for x in left)
                    base, m = len(words), len(left)
                    first += range(base + 1, base + m + 1)
                    partners += [*range(m - 1, m - 1 - shorter, -1), *[0] * (m - shorter)]
                    block = left
                else:
                    first += [len(words) + len(left)] * (len(left) + len(right))
                    partners += [len(right)] * len(left) + [0] * len(right)
                    block = left + right
                words += [x["word"] for x in block]
                counts += [x["n"] for x in block]
            i, j = near_pairs(words, np.array(first), np.array(partners), length, by_suffix)
            if len(i):
                yield _best(words, np.array(counts, np.int64), i, j)


def near_words(words: DataFrame) -> DataFrame:
    """Per word with a near word in ``words`` (distinct word, n): (word, n_near, other, other_n), the most frequent
    near word and its n; of equally frequent ones the first in code-point order."""
    size = F.length("word")
    roles = F.array(*[F.struct((size - k).alias("length"), F.lit(side).alias("by_suffix")) for k in (0, 1) for side in (False, True)])
    entries = words.select("word", "n", F.inline(roles))
    half = (F.col("length") / 2).cast("int")
    part = F.when(F.col("by_suffix"), F.substring("word", size - half + 1, half)).otherwise(F.substring("word", F.lit(1), half))
    entries = entries.where("length > 0").withColumn("part", part)
    keys = ["length", "by_suffix", "part"]
    shorter = F.count_if(F.length("word") == F.col("length"))
    sizes = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), shorter.alias("shorter"))
    sizes = keep(sizes.where("m > 1 AND shorter > 0").drop("shorter"))
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    dealt = entries.join(sizes.withColumn("blocks", blocks), keys)
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    held = dealt.withColumn("block", block).groupBy(*keys, "blocks", "block")
    # A block has about BLOCK words, whatever the size of its group.
    held = keep(held.agg(F.collect_list(F.struct("word", "n")).alias("held")))
    nothing = F.lit(None).cast(held.schema["held"].dataType)
    within = held.where(F.size("held") > 1).select(
        "length", "by_suffix", F.col("held").alias("left"), nothing.alias("right")
    )
    several = held.where("blocks > 1")
    later = F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1))
    first = several.where("block < blocks - 1").select(*keys, F.col("held").alias("left"), later.alias("block"))
    across = first.join(several.select(*keys, "block", F.col("held").alias("right")), [*keys, "block"]).select(
        "length", "by_suffix", "left", "right"
    )
    tiles = within.unionByName(across).repartition(F.xxhash64("length", "by_suffix", "left.word"))
    found = tiles.mapInArrow(_tiles, TILE)
    best = F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("word")))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return near.select("word", "n_near", F.col("best.word").alias("other"), (-F.col("best.minus_n")).alias("other_n"))


def last_forms(links: DataFrame) -> DataFrame:
    """Rows (word, root) for stored links (word, form) without circles: every round doubles the way followed."""
    roots = links.select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = keep(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if further.where("next IS NOT NULL").isEmpty():
            return further.select("word", "root")
        roots = further.drop("next")


def spelling_variants(
    docs: DataFrame, *, least_length: int = 6, least: int = 5, times: int = 5, every: int = 199
) -> DataFrame:
    """One row per frequent word: word, form, root, n, n_near, form_n.

    ``form`` is the most frequent near word if it occurs at least ``times`` as often as the word; ``root`` ends the chain of
    forms.
    """
    setup(docs.sparkSession)
    made = mark()
    words = keep(frequent_words(altered_words(docs, every), least_length, least))
    near = near_words(words)
    is_form = F.col("other_n") >= times * F.col("n")
    linked = keep(
        words.join(near, "word", "left").select(
            "word",
            F.when(is_form, F.col("other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("other_n")).alias("form_n"),
        )
    )
    release_since(made, linked)
    roots = last_forms(linked.where("form IS NOT NULL").select("word", "form"))
    whole = linked.join(roots, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
