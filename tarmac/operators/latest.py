"""Keep one row per key: the latest record wins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Newest first; the later columns only break ties, so the survivor is the same on every run.
NEWEST_FIRST = ("ingestion_timestamp", "record_hash", "batch_id", "source_file_name")

_RANK = "__recency_rank"
_HASH = "__key_hash"
_EARLIER = "__earlier"


def keep_latest(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str] = NEWEST_FIRST
) -> DataFrame:
    """One row per ``keys`` (NULLs compare equal), the first by ``newest_first`` descending.

    The ``rank = 1`` filter lets Spark cut each key to one row per input partition before the
    shuffle, so a key that holds much of the data does not end up in one task.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first if c in df.columns]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def keep_latest_derived(
    basis: DataFrame,
    derive: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    newest_first: Sequence[str] = NEWEST_FIRST,
    carried: Sequence[str] = (),
    hashed: bool = False,
) -> DataFrame:
    """``keep_latest`` of ``derive(basis)`` for wide rows that follow from narrow ones.

    ``derive`` works row by row and keeps the columns it is given. Only those of ``basis``, the keys, the order and the ``carried``
    columns are sorted and exchanged; the other columns are derived from the rows that stay. ``hashed`` sorts by a hash of the
    keys first: rows of different keys are then told apart by one number instead of by comparing texts.
    """
    wide = derive(basis)
    narrow, needed = _narrow(basis, wide, [*keys, *newest_first, *carried])
    order = [F.col(needed[c]).desc_nulls_last() for c in newest_first]
    parts = [needed[c] for c in keys]
    if hashed:
        narrow = narrow.withColumn(_HASH, F.hash(*parts))
        parts = [_HASH, *parts]
    by_key = Window.partitionBy(*parts).orderBy(*order)
    kept = narrow.withColumn(_RANK, F.row_number().over(by_key)).filter(F.col(_RANK) == 1)
    return derive(kept).withColumns({c: F.col(n) for c, n in needed.items()}).select(*wide.columns)


def _narrow(basis: DataFrame, wide: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """The basis with further columns ``names`` of the wide rows, and what these are called there."""
    needed = {c: c if c in basis.columns else f"__{c}" for c in dict.fromkeys(names)}
    further = [F.col(c).alias(n) for c, n in needed.items() if c not in basis.columns]
    return wide.select(*basis.columns, *further), needed


def superseded_derived(
    basis: DataFrame,
    derive: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    earlier: Column,
    newest_first: Sequence[str] = NEWEST_FIRST,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``derive(basis)`` that were the latest of their key among the ``earlier`` ones and are not any more.

    As ``keep_latest_derived``, but with both winners of a key from one aggregate: each key is cut to one row per input
    partition before the only exchange, and nothing has to be joined with what it was before.
    """
    wide = derive(basis)
    flagged = wide.withColumn(_EARLIER, F.coalesce(earlier, F.lit(False)))
    narrow, needed = _narrow(basis, flagged, [*keys, *newest_first, *carried, _EARLIER])
    parts = [needed[c] for c in keys]
    order = [needed[c] for c in newest_first]
    rest = [c for c in narrow.columns if c not in (*parts, *order, needed[_EARLIER])]
    was = F.col(needed[_EARLIER])
    # NULLs are the smallest, that is last in the order.
    winners = narrow.groupBy(F.hash(*parts).alias(_HASH), *parts).agg(
        F.max(F.when(was, F.struct(F.struct(*order).alias("order"), *rest))).alias("old"),
        F.max(F.when(~was, F.struct(*order))).alias("new"),
    )
    gone = winners.filter(F.col("new") > F.col("old.order"))
    kept = gone.select(
        *parts, *[F.col(f"old.order.{c}").alias(c) for c in order], *[F.col(f"old.{c}").alias(c) for c in rest]
    )
    columns = {c: F.col(n) for c, n in needed.items() if c != _EARLIER}
    return derive(kept).withColumns(columns).select(*wide.columns)
