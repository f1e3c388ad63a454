"""Languages of a text as a mixture, inferred by expectation-maximisation.

A text is a sample of byte n-grams (1 to 3 bytes of the lower-cased text, hashed into ``BUCKETS``) from several languages;
each language has an n-gram distribution learnt from labelled texts. Expectation-maximisation estimates
the share of each language; sets of the one, two and three largest shares are refitted, and the set with the
highest log-likelihood less ``PENALTY * log(n-grams)`` per further language is selected. The largest share
names the language.

The distributions are fitted on a sample of at most about ``SAMPLE`` texts per label, taken by hash (the documented bound of
this classifier); every text is classified from all of its n-grams. Null labels and texts are not learnt from. A null
text, or one without a letter, is ``und`` with score 0, as is every text if nothing can be learnt. Repeated rows give
repeated result rows. Columns other than those named are ignored. Ties go to the first label in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.store import setup
from tarmac.llm.words import mix

BUCKETS = 1 << 14
SAMPLE = 4000
PENALTY = 4.0
ROUNDS = 12
REFITS = 6
FOLDS = 5
PIECE = 1 << 18
UNKNOWN = "und"
_U32 = np.uint32
_LETTER = regex.compile(r"\p{L}")
_FACTORS = [_U32(int(x) | 1) for x in mix(np.arange(3, dtype=np.uint64)) >> np.uint64(33)]
_SHIFT = _U32(32 - (BUCKETS.bit_length() - 1))


def ngram_counts(text: str) -> np.ndarray:
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data), PIECE):
        part = data[at : at + PIECE + 2].astype(_U32) + _U32(1)
        value = np.zeros(len(part), _U32)
        for k in range(3):
            n = min(PIECE, len(part) - k)
            if n <= 0:
                break
            value = (value[:n] + part[k : k + n] * _FACTORS[k]) * _U32(0x9E3779B1)
            counts += np.bincount(value >> _SHIFT, minlength=BUCKETS)
    return counts


def _learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            counts = sum((ngram_counts(t) for t in texts), np.zeros(BUCKETS, np.int64))
            seen = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": counts[seen]})


def held_out(doc_id: str = "doc_id"):
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % FOLDS == 0


def learn_languages(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labels in order and their n-gram probabilities (one row per bucket)."""
    labelled = docs.where("lang is not null and text is not null").where(~held_out())
    sizes = labelled.groupBy("lang").count()
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("count")).alias("share"))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.join(share, "lang").where(draw < F.col("share")).select("lang", "text")
    counts = sample.mapInPandas(_learn, "lang string, bucket int, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS, len(names)))
    for k, name in enumerate(names):
        own = counts[counts["lang"] == name]
        table[own["bucket"].to_numpy(), k] = own["n"].to_numpy()
    table += 0.5
    return names, table / table.sum(axis=0)


def _fit(p: np.ndarray, n: np.ndarray, starts: np.ndarray, which: np.ndarray, share: np.ndarray, rounds: int):
    """Shares per text after some rounds, and the log-likelihood; ``which``: the text of each n-gram."""
    total = np.add.reduceat(n, starts)
    for _ in range(rounds):
        part = p * share[which]
        part *= (n / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, starts, axis=0) / total[:, None]
    mixed = np.maximum((p * share[which]).sum(axis=1), 1e-300)
    return share, np.add.reduceat(n * np.log(mixed), starts)


def infer(counts: list[np.ndarray], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares per text over the selected languages (0 elsewhere), and the shares before selection."""
    seen = [np.flatnonzero(c) for c in counts]
    which = np.repeat(np.arange(len(seen)), [len(s) for s in seen])
    starts = np.cumsum([0, *[len(s) for s in seen]])[:-1]
    n = np.concatenate([c[s] for c, s in zip(counts, seen, strict=True)]).astype(float)
    p = table[np.concatenate(seen)]
    k = table.shape[1]
    free, _ = _fit(p, n, starts, which, np.full((len(seen), k), 1.0 / k), ROUNDS)
    order = np.argsort(-free, axis=1, kind="stable")
    cost = PENALTY * np.log(np.add.reduceat(n, starts) + 1)
    best, chosen = None, None
    for size in range(1, min(3, k) + 1):
        mask = np.zeros_like(free)
        np.put_along_axis(mask, order[:, :size], 1.0, axis=1)
        start = np.maximum(free, 1e-6) * mask
        share, fit = _fit(p, n, starts, which, start / start.sum(axis=1)[:, None], REFITS if size > 1 else 0)
        value = fit - cost * (size - 1)
        if best is None:
            best, chosen = value, share
        else:
            better = value > best
            best = np.where(better, value, best)
            chosen[better] = share[better]
    return chosen, free


def _predict(texts: list, names: list[str], table: np.ndarray) -> pd.DataFrame:
    texts = [t if isinstance(t, str) else "" for t in texts]
    good = [i for i, t in enumerate(texts) if names and _LETTER.search(t)]
    label, score, sets = [UNKNOWN] * len(texts), [0.0] * len(texts), [""] * len(texts)
    if good:
        shares, free = infer([ngram_counts(texts[i]) for i in good], table)
        top = shares.argmax(axis=1)
        for j, i in enumerate(good):
            label[i] = names[top[j]]
            score[i] = float(min(1.0, max(0.0, free[j, top[j]])))
            sets[i] = ",".join(names[k] for k in np.flatnonzero(shares[j] > 0))
    return pd.DataFrame({"lang_pred": label, "score": score, "languages": sets})


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 64):
            yield batch.iloc[at : at + 64].reset_index(drop=True)


RESULT = "doc_id long, held_out boolean, lang_pred string, score double, languages string"


def predict_languages(docs: DataFrame) -> DataFrame:
    """One row per document; columns as in ``RESULT``. score: share of the predicted language among all."""
    setup(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    names, table = learn_languages(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _parts(batches):
            found = _predict(part["text"].tolist(), names, table)
            ids = part["doc_id"].astype("Int64")
            yield pd.concat([ids, part["held_out"], found], axis=1)

    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInPandas(run, RESULT)


def add_language(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns lang_pred and lang_score."""
    setup(docs.sparkSession)
    names, table = learn_languages(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = _predict(part.column("text").to_pylist(), names, table)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found["lang_pred"], pa.string()), pa.array(found["score"], pa.float64())],
                    [*part.schema.names, "lang_pred", "lang_score"],
                )

    schema = T.StructType(
        [*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    )
    return docs.mapInArrow(run, schema)
