"""Token counts of whole texts; huge documents are encoded as overlapping chunks and spliced where that is proven right.

Texts of up to ``CHUNK`` code points are counted where they are. Longer ones are cut into chunks that begin ``OVERLAP``
code points before the end of the one before, are dealt over all tasks and encoded with offsets. A chunk reports its
number of tokens and those tokens that touch an overlap; where two chunks meet, the tokens that both know decide the splice.

A splice goes behind a token that both encodings have with the same id and the same span, and that is *proven stable*:

* It ends its word in both. Words are found from left to right by a pattern without look-behind, so that what
  follows a common word end is the same in both, and what precedes it has been read by the left chunk alone. The end must
  be ``MARGIN`` code points away from the end of the left chunk, so that no contraction or special token is cut there.
* Or it is followed, in both, by more of a word that began at least ``LONGEST_CONTRACTION`` code points earlier. Such a word is a
  run of one character class and ends where that run does, in both chunks. Byte-pair encoding has the property that a
  sequence of tokens is the encoding of a word exactly if each two neighbours are: all neighbours up to the token stand side
  by side in the left encoding, all from the token on in the right one.

An overlap without any token is white space, and either side of it will do. Chunks begin and end before a character that
never combines with its predecessor, which keeps normalisation the same. If the tokens of an overlap never agree (as in one
endless word of repeated letters), the document is cut anew with overlaps and, as needed, chunks ``WIDER`` times as
long, until it is one chunk.

Null and empty texts have no tokens and no bytes. Repeated rows, also those without a doc_id, give one row each. Columns
other than doc_id and text are ignored; an empty table gives no rows. The tokenizer file must be present on every worker.
"""

from __future__ import annotations

import os
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import keep, setup

CHUNK = 1 << 14
OVERLAP = 512
WIDER = 8
MARGIN = 16
LONGEST_CONTRACTION = 3
# Texts that the library encodes at once: bounds its memory.
AT_ONCE = 64
# Remembered stretches of a task: code points in all (an entry weighs as much as ENTRY of them), and of one.
REMEMBERED = 1 << 25
ENTRY, LONGEST_REMEMBERED = 100, 64
SEPARATORS, WHITE = regex.compile("[\x1c-\x1f]"), regex.compile("\\s+", regex.V0)
# What may combine with a character before it: marks, Hangul vowels and finals, Kirat Rai vowels.
STARTS = regex.compile("[^\\p{M}ᅠ-ᇿힰ-퟿\U00016d63-\U00016d6a]")


@cache
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per Spark task
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def cuts(text: str, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Begin and end of each chunk."""

    def safe(place: int) -> int:
        found = STARTS.search(text, place) if place < len(text) else None
        return found.start() if found else len(text)

    out, begin, nominal = [], 0, 0
    while True:
        nominal += chunk
        end = safe(nominal) if nominal < len(text) else len(text)
        out.append((begin, end))
        if end == len(text):
            return out
        nominal = max(nominal, end - overlap)  # beyond a long run of marks
        begin = min(end, safe(max(begin, end - overlap)))


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                places = cuts(text, chunk, overlap)
                for low in range(0, len(places), AT_ONCE):
                    some = places[low : low + AT_ONCE]
                    after = [b for b, _ in places[low + 1 : low + AT_ONCE + 1]]
                    before = [places[low - 1][1] if low else 0] + [e for _, e in some[:-1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(some), pa.int64()),
                            pa.array(range(low, low + len(some)), pa.int64()),
                            pa.array([b for b, _ in some], pa.int64()),
                            # The overlaps: with the chunk before up to here, with the next from here on.
                            pa.array(before, pa.int64()),
                            pa.array(after + [None] * (len(some) - len(after)), pa.int64()),
                            pa.array([text[b:e] for b, e in some], pa.string()),
                        ],
                        ["row", "piece", "begin", "head_end", "tail_begin", "text"],
                    )

    return run


PIECES = "row long, piece long, begin long, head_end long, tail_begin long, text string"
ENCODED = "row long, piece long, n long, begin long, end long, head binary, tail binary"


def _tokens(encoding, begin: int, low: int, high: int | None) -> np.ndarray:
    """The tokens that end after ``low`` and, with ``high``, start before it.

    Per token: id, start, end, start of its word, whether it ends its word and whether it ends its last character.
    """
    ids, spans, words = encoding.ids, encoding.offsets, encoding.word_ids
    n = len(ids)
    first = bisect_right(spans, low - begin, key=lambda s: s[1])
    end = n if high is None else bisect_left(spans, high - begin, key=lambda s: s[0])
    if first >= end:
        return np.zeros((0, 6), np.int64)
    start = first  # where the word of the token at hand begins
    while start and words[start - 1] == words[first]:
        start -= 1
    rows = []
    for i in range(first, end):
        if words[i] != words[start]:
            start = i
        a, b = spans[i]
        last = i + 1 == n or words[i + 1] != words[i]
        whole = i + 1 == n or spans[i + 1][0] >= b
        rows.append((ids[i], a + begin, b + begin, spans[start][0] + begin, last, whole))
    return np.array(rows, np.int64)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(path)
        for batch in batches:
            for low in range(0, batch.num_rows, AT_ONCE):
                rows = batch.slice(low, AT_ONCE).to_pylist()
                n, heads, tails = [], [], []
                for row, encoding in zip(
                    rows, library.encode_batch([r["text"] for r in rows], add_special_tokens=False), strict=True
                ):
                    begin, tail = row["begin"], row["tail_begin"]
                    n.append(len(encoding))
                    heads.append(_tokens(encoding, begin, begin, row["head_end"]).tobytes() if row["piece"] else b"")
                    tails.append(b"" if tail is None else _tokens(encoding, begin, tail, None).tobytes())
                ends = [r["begin"] + len(r["text"]) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([r[c] for r in rows], pa.int64()) for c in ("row", "piece")),
                        pa.array(n, pa.int64()),
                        pa.array([r["begin"] for r in rows], pa.int64()),
                        pa.array(ends, pa.int64()),
                        pa.array(heads, pa.binary()),
                        pa.array(tails, pa.binary()),
                    ],
                    ["row", "piece", "n", "begin", "end", "head", "tail"],
                )

    return run


def doubled_tokens(tail: np.ndarray, head: np.ndarray, left_end: int, right_begin: int) -> int | None:
    """Tokens that two neighbouring chunks count too many; None where no splice is proven.

    ``tail``: the left chunk's tokens that touch the overlap, to its end; ``head``: the right one's from its beginning.
    """
    if not len(tail) and not len(head):
        return 0 if right_begin < left_end else None
    known = {tuple(t[:3]): j for j, t in enumerate(head.tolist())}
    for i, (token, start, end, word, last, whole) in enumerate(tail.tolist()):
        j = known.get((token, start, end))
        if j is None or not whole or end > left_end - MARGIN:
            continue
        _, _, _, other_word, other_last, other_whole = head[j].tolist()
        if not other_whole or last != other_last:
            continue
        if last or end - max(word, other_word) > LONGEST_CONTRACTION:
            return (len(tail) - 1 - i) + (j + 1)
    return None


def _splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        doubled = [
            doubled_tokens(
                *(np.frombuffer(r[c], np.int64).reshape(-1, 6) for c in ("tail", "head")), r["left_end"], r["right_begin"]
            )
            for r in rows
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["row"] for r in rows], pa.int64()), pa.array(doubled, pa.int64())], ["row", "doubled"]
        )


def _spliced(pending: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Stored rows (row, n_tokens) for rows (row, text); null where some pair of chunks could not be spliced."""
    pieces = pending.select("row", "text").mapInArrow(_cut(chunk, overlap), PIECES)
    # The chunks of one document go to many tasks.
    encoded = keep(pieces.repartition(F.xxhash64("row", "piece")).mapInArrow(_encode(path), ENCODED))
    left = encoded.select("row", "piece", "tail", F.col("end").alias("left_end"))
    right = encoded.where("piece > 0").select(
        "row", (F.col("piece") - 1).alias("piece"), "head", F.col("begin").alias("right_begin")
    )
    doubled = left.join(right, ["row", "piece"]).mapInArrow(_splice, "row long, doubled long")
    parts = encoded.select("row", "n", F.lit(False).alias("open")).union(
        doubled.select("row", -F.coalesce("doubled", F.lit(0)), F.col("doubled").isNull())
    )
    total = parts.groupBy("row").agg(F.sum("n").alias("n"), F.bool_or("open").alias("open"))
    return keep(total.select("row", F.when(~F.col("open"), F.col("n")).alias("n_tokens")))


class Counter:
    """Tokens of whole texts, counted stretch by stretch: white space is a boundary in any context.

    Counts of short stretches are remembered, up to ``REMEMBERED`` code points of them.
    """

    def __init__(self, path: str):
        self.library = _library(path)
        self.known: dict[str, int] = {}
        self.size = 0

    @staticmethod
    def stretches(text: str) -> list[str]:
        # Python splits at four separators that the tokenizer does not count as white space.
        return WHITE.split(text) if SEPARATORS.search(text) else text.split()

    def _encode(self, stretches: list[str]) -> list[int]:
        return list(map(len, self.library.encode_batch_fast(stretches, add_special_tokens=False)))

    def count(self, texts: list[str]) -> list[int]:
        parts = [self.stretches(t) for t in texts]
        fresh = [w for w in {w for p in parts for w in p} if w not in self.known]
        found = dict(zip(fresh, self._encode(fresh), strict=True)) if fresh else {}
        counts = [sum([self.known[w] if w in self.known else found[w] for w in p]) for p in parts]
        if self.size > REMEMBERED:
            self.known.clear()
            self.size = 0
        for w, n in found.items():
            if len(w) <= LONGEST_REMEMBERED:
                self.known[w] = n
                self.size += len(w) + ENTRY
        return counts


def _whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)  # goes with the task
        for batch in batches:
            n: list[int] = []
            for low in range(0, batch.num_rows, AT_ONCE):
                n += counter.count([t or "" for t in batch.column("text").slice(low, AT_ONCE).to_pylist()])
            columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(
    docs: DataFrame, path: str, *, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``path``: a file of the tokenizers library; ``chunk`` is at least twice ``overlap``.
    """
    if chunk < 2 * overlap or overlap <= MARGIN:
        raise ValueError("a chunk must be at least two overlaps long, an overlap longer than its margin")
    setup(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    huge = F.coalesce(F.length("text") > chunk, F.lit(False))
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    schema = "doc_id long, n_bytes long, n_tokens long"
    counted = docs.where(~huge).select(doc_id, size, "text").mapInArrow(_whole(path), schema)
    long = keep(docs.where(huge).select(F.monotonically_increasing_id().alias("row"), doc_id, size, "text"))
    pending = long
    while not pending.isEmpty():
        totals = _spliced(pending, path, chunk, overlap)
        done = totals.where("n_tokens IS NOT NULL")
        counted = counted.union(long.join(done, "row").select("doc_id", "n_bytes", "n_tokens"))
        failed = totals.where("n_tokens IS NULL").select("row")
        overlap *= WIDER
        chunk = max(chunk, 2 * overlap)
        pending = long.join(failed, "row")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
