"""Quartile bucket digests of texts, and the texts compared with an edited version and their successor.

A window of five bytes slides over the UTF-8 text; six byte triplets of each window are hashed into 256
buckets. The digest holds two bits per bucket (the quartile of its count), the length on a log scale and the
ratios of the quartiles. Two digests differ by a weighted sum of bucket steps plus header steps, cut off at
``BOUND``; the likeness is ``1 - difference / BOUND``.

Null counts as the empty text, whose digest is that of empty buckets. Texts of fewer than five bytes are padded with
zero bytes. Equal texts have equal digests. Repeated doc_ids are ordered by a hash of the text, null doc_ids come
first, and every row gets a result. A single row is its own successor. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.store import keep, setup
from tarmac.llm.words import mix

BUCKETS = 256
BOUND = 600
PIECE = 1 << 18
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
_TABLES = [(mix(np.arange(256, dtype=np.uint64) + np.uint64(256 * k)) & np.uint64(255)).astype(np.uint8) for k in range(3)]
_SALTS = [np.uint8(37 * k + 1 & 255) for k in range(len(TRIPLETS))]
_STEPS = np.array([0, 1, 2, 6])


def bucket_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    if not data:
        return counts
    every = np.frombuffer(data.ljust(5, b"\0"), np.uint8)
    for at in range(0, len(every) - 4, PIECE):
        part = every[at : at + PIECE + 4]
        n = len(part) - 4
        first, second, third = (table[part] for table in _TABLES)
        for (j, k), salt in zip(TRIPLETS, _SALTS, strict=True):
            bucket = first[:n] ^ second[j : j + n] ^ third[k : k + n] ^ salt
            counts += np.bincount(bucket, minlength=BUCKETS)
    return counts


def length_code(size: int) -> int:
    return min(255, int(8 * math.log2(size + 1)))


def digest(text: str) -> str:
    data = text.encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    order = np.sort(counts)
    q1, q2, q3 = (int(order[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = (codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6).astype(np.uint8)
    ratios = (q1 * 15 // q3) << 4 | (q2 * 15 // q3) if q3 else 0
    return f"{length_code(len(data)):02x}{ratios:02x}{body.tobytes().hex()}"


def _parts(fingerprint: str) -> tuple[int, int, int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    body = (raw[2:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3
    return int(raw[0]), int(raw[1]) >> 4, int(raw[1]) & 15, body.astype(np.int8).ravel()


def difference(a: str, b: str) -> int:
    if a == b:
        return 0
    (la, ra, sa, x), (lb, rb, sb, y) = _parts(a), _parts(b)
    total = int(_STEPS[np.abs(x - y)].sum()) + 4 * abs(la - lb)
    return min(BOUND, total + 4 * max(0, abs(ra - rb) - 1) + 4 * max(0, abs(sa - sb) - 1))


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / BOUND


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(doc_id, text: str, own: str, following: str, after: str) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    other = own if edited == text else digest(edited)
    return doc_id, len(text), sha, own, other, likeness(own, other), likeness(own, after)


_NAMES = [x.split()[0] for x in COLUMNS.split(", ")]
_TYPES = dict(zip(_NAMES, ["Int64", "Int64", "object", "object", "object", "float64", "float64"], strict=True))


def _frame(rows: list[tuple], kind: str, part: int, text: list | None = None) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_NAMES).astype(_TYPES)
    return frame.assign(kind=kind, part=part, text=text)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row with the next of the partition; the ends of the partition are left open."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            text = text if isinstance(text, str) else ""
            now = (None if pd.isna(doc_id) else int(doc_id), text, digest(text))
            if before is None:
                opening = (now[0], None, None, now[2], None, None, None)
                yield _frame([opening], "first", part, [text])
            else:
                rows.append(_compared(*before, now[1], now[2]))
            before = now
        if rows:
            yield _frame(rows, "done", part)
    if before is not None:
        yield _frame([(before[0], None, None, before[2], None, None, None)], "last", part, [before[1]])


def _close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            _compared(None if pd.isna(r.doc_id) else int(r.doc_id), r.text, r.fingerprint, r.following, r.after)
            for r in batch.itertuples()
        ]
        yield pd.DataFrame(rows, columns=_NAMES).astype(_TYPES)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``; columns as in ``COLUMNS``.

    Texts move once, into ranges of doc_id; only the first and last text of each range move again.
    """
    spark = setup(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keys = ("doc_id", F.xxhash64("text"))
    ranged = docs.repartitionByRange(*keys).sortWithinPartitions(*keys)
    walked = keep(ranged.mapInPandas(_walk, f"{COLUMNS}, kind string, part int, text string"))
    first = walked.where("kind = 'first'").select("part", "text", "fingerprint")
    order = Window.orderBy("part")  # one row per range
    nexts = first.select("part").withColumn("to", F.lead("part").over(order))
    nexts = keep(nexts.withColumn("to", F.coalesce("to", F.min("part").over(Window.partitionBy()))))
    opens = first.select(
        F.col("part").alias("to"), F.col("text").alias("following"), F.col("fingerprint").alias("after")
    )
    ends = walked.where("kind = 'last'").select("doc_id", "text", "fingerprint", "part")
    closed = ends.join(nexts, "part").join(opens, "to").mapInPandas(_close, COLUMNS)
    return walked.where("kind = 'done'").select(*_NAMES).union(closed)
