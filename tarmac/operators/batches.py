"""Batch-wise replacement on plain DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_ids(df: DataFrame) -> DataFrame:
    """The distinct, known batch ids of ``df`` (an empty frame when it has no such column)."""
    if "batch_id" not in df.columns:
        return df.select(F.lit(None).cast("string").alias("batch_id")).limit(0)
    return df.select("batch_id").filter(F.col("batch_id").isNotNull()).distinct()


def replace_batches(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """``current`` without the batches that ``incoming`` delivers again, plus ``incoming``.

    A load names few batches and a batch holds many rows: the ids are broadcast, so that no task gets all rows of a batch.
    """
    kept = current.join(F.broadcast(batch_ids(incoming)), "batch_id", "left_anti")
    return kept.unionByName(incoming)
