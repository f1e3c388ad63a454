"""Canonical JSON of a row and its SHA-256 fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(columns: Sequence[str]) -> Column:
    """JSON of the named columns in alphabetical order, NULLs included."""
    ordered = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def with_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``raw_record`` (payload snapshot) and ``record_hash`` (hash of row and payload)."""
    names = list(columns or df.columns)
    with_payload = df.withColumn("raw_record", canonical_json(names))
    return with_payload.withColumn(
        "record_hash", F.sha2(canonical_json([*names, "raw_record"]), 256)
    )
