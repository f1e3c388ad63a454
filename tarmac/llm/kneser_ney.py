"""Interpolated modified Kneser-Ney bigram model, counted in Spark and applied to every text.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end token per text.

1. Texts become blocks: a sorted array of word hashes and the tokens as positions in it. A block holds about
   ``BLOCK_TOKENS`` tokens (a longer text is a block of its own).
2. Each block sends its distinct bigrams, with their counts in training texts, to shards by the hash of the first word. A word
   that makes up more than ``1 / SPREAD`` of all tokens is spread over shards by both words, as is the start mark; there are at most
   ``SPREAD`` of them. The number of shards grows with the corpus, so a shard's size does not.
3. A shard adds up the counts, sends each block the totals for its bigrams (in the block's own order, so that hashes
   need not travel back) and the context and continuation statistics of words, which Spark sums.
4. A block's worker stores its slice of the model as sorted hash arrays in a file, maps it into memory, and
   scores its texts.

Null counts as the empty text, which has the end token alone. Repeated rows give repeated result rows; a null doc_id
is held out if its hash says so (null hashes as the empty string). Without training texts every probability
is uniform over unseen words, i.e. 1. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import WIDE_BYTES, keep, release, setup, trim
from tarmac.llm.words import mix, words_of

BLOCK_TOKENS = 1_000_000
SHARD_TOKENS = 3_000_000
SPREAD = 65_536
LOOKED_UP_AT_ONCE = 65_536
FOLDS, HELD_OUT = 7, 2

_U = np.uint64
END = mix(np.array([0x656E64], _U))[0]
START = mix(np.array([0x7374617274], _U))[0]


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: the leading ones, mostly zero, take next to nothing where they are stored or sent."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _from_planes(planes: bytes, kind: type) -> np.ndarray:
    parts = np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(parts.T).view(kind).ravel()


def _all_of(column: list[bytes], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(_from_planes(x, kind) for x in column)])


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash for each bigram."""
    pair = mix(second)
    pair += first * _U(3)
    return mix(pair)


# ---- blocks --------------------------------------------------------------------------------


def _block(ids: list, held: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
    vocabulary, places = np.unique(np.concatenate(tokens), return_inverse=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([np.cumsum([len(t) for t in tokens])], pa.list_(pa.int64())),
            pa.array([vocabulary.tobytes()], pa.binary()),
            pa.array([_planes(places.astype(np.uint32))], pa.binary()),
        ],
        ["doc_ids", "held", "ends", "vocabulary", "tokens"],
    )


BLOCK = "doc_ids array<long>, held array<boolean>, ends array<long>, vocabulary binary, tokens binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, held, tokens, total = [], [], [], 0
    for batch in batches:
        words = words_of(batch.column("text"))
        for i, (doc_id, out) in enumerate(
            zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), strict=True)
        ):
            ids.append(doc_id)
            held.append(out)
            tokens.append(np.append(words.hashes[words.of(i)], END))
            total += len(tokens[-1])
            if total >= BLOCK_TOKENS:
                yield _block(ids, held, tokens)
                ids, held, tokens, total = [], [], [], 0
                trim()
    if ids:
        yield _block(ids, held, tokens)
        del ids, held, tokens
    trim()


class Block:
    """A block read back: word hashes (start mark last), tokens and their predecessors as positions."""

    def __init__(self, ends: list[int], held: list[bool], vocabulary: bytes, tokens: bytes):
        words = np.frombuffer(vocabulary, _U)
        self.words = np.append(words, START)
        self.tokens = _from_planes(tokens, np.uint32)
        self.ends = np.asarray(ends, np.int64)
        self.begins = np.append(0, self.ends[:-1])
        self.train = np.repeat(~np.asarray(held, bool), self.ends - self.begins)

    def bigrams(self, shards: int, spread: np.ndarray):
        """Distinct bigrams by shard: (first, second, shard, count in training texts, bigram of each token)."""
        key = np.empty(len(self.tokens), np.int64)
        key[1:] = self.tokens[:-1]
        key[self.begins] = len(self.words) - 1
        key *= len(self.words)
        key += self.tokens
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        runs = np.flatnonzero(new)
        count = np.add.reduceat(self.train[order], runs, dtype=np.int64)
        which = np.empty(len(order), np.int32)
        which[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        del order, new
        first, second = (x.astype(np.int32) for x in np.divmod(key[runs], len(self.words)))
        del key, runs
        place = mix(self.words)
        shard = place[first]
        if len(spread):
            at = np.minimum(np.searchsorted(spread, self.words), len(spread) - 1)
            wide = (spread[at] == self.words)[first]
            shard[wide] = mix(shard[wide] + self.words[second[wide]])
        shard = (shard % _U(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        back = np.empty(len(order), np.int32)
        back[order] = np.arange(len(order), dtype=np.int32)
        return first[order], second[order], shard[order], count[order], back[which]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        columns = [batch.column(c) for c in ("blk", "ends", "held", "vocabulary", "tokens")]
        for i in range(batch.num_rows):
            blk, *rest = (c[i].as_py() for c in columns)
            yield blk, Block(*rest)
            del rest
            trim()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, block in _blocks(batches):
        count = np.bincount(block.tokens[block.train], minlength=len(block.words))
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.words[seen].view(np.int64)), pa.array(count[seen])], ["word", "c"]
        )


def _word_shards(words: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard numbers in use, bounds, and the order that sorts the words by shard."""
    shard = words.view(np.int64) % shards
    order = np.argsort(shard, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(words))
    return shard[order][cuts[:-1]], cuts, order


def _asking(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blk, block in _blocks(batches):
            numbers, cuts, order = _word_shards(block.words, shards)
            words = block.words[order]
            asked = [words[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(numbers), blk)), pa.array(numbers), pa.array(asked, pa.binary())],
                ["blk", "shard", "words"],
            )

    return run


def _answer(asked: pa.Table, stats: pa.Table) -> pa.Table:
    """Statistics of one shard's words for each block that asks, in the order of its words."""
    known = stats.column("word").to_numpy().view(_U)
    order = np.argsort(known)
    known = known[order]
    values = np.stack([stats.column(c).to_numpy()[order] for c in _LOOKED_UP], axis=1).reshape(len(known), -1)
    found = []
    for words in asked.column("words").to_pylist():
        words = np.frombuffer(words, _U)
        out = np.zeros((len(words), len(_LOOKED_UP)), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            there = known[at] == words
            out[there] = values[at[there]]
        found.append(_planes(out.T.ravel()))
    return pa.table({"blk": asked.column("blk"), "shard": asked.column("shard"), "counts": pa.array(found, pa.binary())})


def _outgoing(shards: int, spread: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blk, block in _blocks(batches):
            first, second, shard, count, _ = block.bigrams(shards, spread)
            cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
            rows: list[list] = [[], [], [], [], []]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                runs = np.append(np.flatnonzero(np.diff(first[a:b], prepend=-1)), b - a)
                firsts = block.words[first[a + runs[:-1]]]
                rows[0].append(int(shard[a]))
                rows[1].append(firsts.tobytes())
                rows[2].append(_planes(np.diff(runs).astype(np.uint32)))
                rows[3].append(block.words[second[a:b]].tobytes())
                rows[4].append(_planes(count[a:b].astype(np.uint32)))
            n = len(rows[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, blk)), pa.array(rows[0], pa.int64()), *(pa.array(r, pa.binary()) for r in rows[1:])],
                ["blk", "shard", "firsts", "runs", "seconds", "counts"],
            )
            del block, first, second, shard, count, rows

    return run


SENT = "blk long, shard long, firsts binary, runs binary, seconds binary, counts binary"
MERGED = "blk long, shard long, counts binary, word long, n1 long, n2 long, n3 long, ctx long, cont long"
_NAMES = ["blk", "shard", "counts", "word", "n1", "n2", "n3", "ctx", "cont"]
_SCHEMA = pa.schema([(n, pa.binary() if n == "counts" else pa.int64()) for n in _NAMES])


def _merge(table: pa.Table) -> pa.Table:
    """One shard: totals back to the blocks, statistics of its words."""
    rows = table.num_rows
    seconds = [np.frombuffer(x.as_buffer(), _U) for x in table.column("seconds")]
    cuts = np.cumsum([0, *map(len, seconds)])
    first = np.concatenate(
        [
            np.repeat(np.frombuffer(u.as_buffer(), _U), _from_planes(n.as_buffer(), np.uint32))
            for u, n in zip(table.column("firsts"), table.column("runs"), strict=True)
        ]
    )
    second = np.concatenate(seconds)
    count = np.concatenate([_from_planes(x.as_buffer(), np.uint32) for x in table.column("counts")])
    pair = _pair(first, second)
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    begins = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    del pair
    total = np.add.reduceat(count[order], begins, dtype=np.int64) if len(order) else begins
    del count
    answers = np.empty(len(order), np.uint32)
    answers[order] = np.repeat(total.astype(np.uint32), np.diff(begins, append=len(order)))
    back = pa.table(
        {
            "blk": table.column("blk"),
            "shard": table.column("shard"),
            "counts": pa.array([_planes(answers[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            **{n: pa.nulls(rows, pa.int64()) for n in _NAMES[3:]},
        },
        schema=_SCHEMA,
    )
    del answers
    index = order[begins]
    del order, seconds
    seen = total > 0
    index, total = index[seen], total[seen]
    u, w = first[index], second[index]
    del first, second, index, seen
    words, places = np.unique(np.concatenate([u, w]), return_inverse=True)
    at_u, at_w = places[: len(u)], places[len(u) :]
    n = len(words)
    sums = [np.bincount(at_u[total == k], minlength=n) for k in (1, 2)]
    sums.append(np.bincount(at_u[total > 2], minlength=n))
    sums.append(np.bincount(at_u, weights=total, minlength=n).astype(np.int64))
    sums.append(np.bincount(at_w, minlength=n))
    of_counts = np.bincount(np.minimum(total, 5), minlength=6)
    # One more row, without a word: how many bigrams occur 1, 2, 3 and 4 times, and at all.
    stats = pa.table(
        {
            "blk": pa.nulls(n + 1, pa.int64()),
            "shard": pa.nulls(n + 1, pa.int64()),
            "counts": pa.nulls(n + 1, pa.binary()),
            "word": pa.array(np.append(words.view(np.int64), 0), mask=np.arange(n + 1) == n),
            **{
                name: pa.array(np.append(x, extra).astype(np.int64))
                for name, x, extra in zip(_NAMES[4:], sums, [*of_counts[1:5], len(total)], strict=True)
            },
        },
        schema=_SCHEMA,
    )
    del u, w, total, words, places, at_u, at_w, sums
    trim()
    return pa.concat_tables([back, stats])


# ---- probabilities -------------------------------------------------------------------------


def discounts(counts: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many n-grams occur 1, 2, 3 and 4 times."""
    n = [0, *counts]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
    return np.array(
        [0.0] + [min(k, max(0.0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else min(k, y) for k in (1, 2, 3)]
    )


class Model:
    """Scalars of the model."""

    def __init__(self, tokens: int, types: int, bigram: list[int], distinct: int, unigram: list[int]):
        self.tokens, self.types, self.distinct = tokens, types, distinct
        self.two, self.one = discounts(bigram), discounts(unigram[:4])
        tail = np.array([0, unigram[0], unigram[1], unigram[4] - unigram[0] - unigram[1]])
        self.gamma = float((self.one * tail).sum()) / distinct if distinct else 1.0

    def word_probability(self, cont: np.ndarray) -> np.ndarray:
        lower = self.gamma / (self.types + 1)
        if not self.distinct:
            return np.full(len(cont), lower)
        return (cont - self.one[np.minimum(cont, 3)]) / self.distinct + lower

    def bigram_probability(self, c, ctx, n1, n2, n3, lower):
        seen = np.maximum(ctx, 1)
        gamma = np.where(ctx > 0, (self.two[1] * n1 + self.two[2] * n2 + self.two[3] * n3) / seen, 1.0)
        return (c - self.two[np.minimum(c, 3)]) / seen + gamma * lower

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.tokens + self.types + 1))


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_LOOKED_UP = ["c", "cont", "n1", "n2", "n3", "ctx"]


class Slice:
    """Part of the model in a file: sorted hashes and the values that belong to them, mapped into memory."""

    def __init__(self, folder: str, name: str, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        for part, array in (("keys", hashes[order]), ("values", values[order])):
            np.save(os.path.join(folder, f"{name}-{part}.npy"), array)
            setattr(self, part, np.load(os.path.join(folder, f"{name}-{part}.npy"), mmap_mode="r"))

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        return self.values[np.searchsorted(self.keys, hashes)]


def _score(model: Model, shards: int, spread: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        body = table.take(np.flatnonzero(kind == 0)).to_pylist()[0]
        block = Block(body["ends"], body["held"], body["vocabulary"], body["tokens"])
        totals = table.take(np.flatnonzero(kind == 1))
        order = np.argsort(totals.column("shard").to_numpy())
        counts = totals.column("counts").to_pylist()
        count = _all_of([counts[i] for i in order], np.uint32)
        stats = table.take(np.flatnonzero(kind == 2))
        order = np.argsort(stats.column("shard").to_numpy())
        answers = stats.column("counts").to_pylist()
        parts = [_from_planes(answers[i], np.int64).reshape(len(_LOOKED_UP), -1) for i in order]
        hashes, values = block.words[_word_shards(block.words, shards)[2]], np.concatenate(parts, axis=1).T
        del totals, counts, stats, answers, parts
        first, second, _, _, which = block.bigrams(shards, spread)
        pair = _pair(block.words[first], block.words[second])
        logs = np.empty(len(pair))
        with tempfile.TemporaryDirectory() as folder:
            words = Slice(folder, "words", hashes, values)
            bigrams = Slice(folder, "bigrams", pair, count)
            del hashes, values, count
            own = words[block.words]
            lower = model.word_probability(own[:, 1])
            for a in range(0, len(pair), LOOKED_UP_AT_ONCE):
                part = slice(a, a + LOOKED_UP_AT_ONCE)
                context = words[block.words[first[part]]]
                c = bigrams[pair[part]].astype(np.int64)
                p = model.bigram_probability(c, context[:, 5], *context[:, 2:5].T, lower[second[part]])
                logs[part] = np.log10(p)
            del words, bigrams, pair, first, second
        c = own[:, 0]
        add = [np.add.reduceat(x[places], block.begins) for x, places in ((model.base(c), block.tokens), (logs, which))]
        known = np.add.reduceat((c > 0)[block.tokens].astype(np.int64), block.begins)
        del logs, which
        n = len(block.ends)
        trim()
        return pa.table(
            {
                "doc_id": pa.array(body["doc_ids"], pa.int64()),
                "held_out": pa.array(body["held"], pa.bool_()),
                "n_tokens": block.ends - block.begins,
                "n_known": known,
                "train_tokens": np.full(n, model.tokens),
                "base_score": add[0],
                "score": add[1],
            }
        )

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text); columns as in ``RESULT``."""
    spark = setup(docs.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(WIDE_BYTES))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (F.crc32(key) % FOLDS == HELD_OUT).alias("held")
    )
    blocks = docs.mapInArrow(_pack, BLOCK).withColumn("blk", F.monotonically_increasing_id())
    blocks = keep(blocks, wide=True)

    words = keep(blocks.mapInArrow(_word_counts, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")))
    tokens, types = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).head()
    shards = max(1, -(-tokens // SHARD_TOKENS))
    often = words.where(F.col("c") * SPREAD > tokens).select("word").toPandas()["word"]
    # Each text has a start mark, whose bigrams would all meet in one shard.
    spread = np.sort(np.append(often.to_numpy(np.int64).view(_U), START))

    sent = blocks.mapInArrow(_outgoing(shards, spread), SENT)
    merged = keep(sent.groupBy("shard").applyInArrow(_merge, MERGED))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _NAMES[4:]]
    of_counts = merged.where("blk is null and word is null").agg(*sums).head()
    zero = [F.lit(0).cast("long").alias(c) for c in _NAMES[4:]]
    stats = merged.where("word is not null").select("word", F.lit(0).cast("long").alias("c"), *_NAMES[4:])
    stats = stats.union(words.select("word", "c", *zero))
    stats = keep(stats.groupBy("word").agg(F.sum("c").alias("c"), *sums))
    exact = [F.count_if(F.col("cont") == k) for k in (1, 2, 3, 4)]
    unigram = stats.agg(*exact, F.count_if(F.col("cont") > 0)).head()
    model = Model(tokens, types, list(of_counts[:4]), of_counts["cont"], list(unigram))

    asked = blocks.mapInArrow(_asking(shards), "blk long, shard long, words binary")
    known = stats.select(F.pmod("word", F.lit(shards)).alias("shard"), "word", *_LOOKED_UP)
    answers = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(
        _answer, "blk long, shard long, counts binary"
    )
    answers = keep(answers)
    totals = keep(merged.where("blk is not null").select("blk", "shard", "counts"))
    release(merged, stats, words)
    parts = (
        blocks.withColumn("kind", F.lit(0))
        .unionByName(totals.withColumn("kind", F.lit(1)), True)
        .unionByName(answers.withColumn("kind", F.lit(2)), True)
    )
    return parts.groupBy("blk").applyInArrow(_score(model, shards, spread), RESULT)
