"""Lineage columns every raw row carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.codes import is_blank

LINEAGE_COLUMNS = ("source_file_name", "source_system", "ingestion_timestamp", "batch_id")


def scanned_file_name() -> Column:
    """Name of the file a row was read from (use right at the scan); Spark gives it percent-encoded."""
    name = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(name), F.col("_metadata.file_name"))


def _kept_or(df: DataFrame, name: str, fallback: Column) -> Column:
    if name not in df.columns:
        return fallback
    return F.when(is_blank(F.col(name)), fallback).otherwise(F.col(name))


def fill_lineage(
    df: DataFrame,
    *,
    source_system: str,
    file_name: Column,
    batch_id: str | None = None,
    fallback_batch_id: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Complete the lineage columns, keeping what the feed already says.

    A given ``batch_id`` replaces the feed's. ``fallback_batch_id`` only fills gaps, so that
    every row belongs to a batch that a rerun can replace.
    """
    now = F.current_timestamp() if now is None else now
    stamp = now
    if "ingestion_timestamp" in df.columns:
        stamp = F.coalesce(F.col("ingestion_timestamp").try_cast("timestamp"), now)
    columns = {
        "source_file_name": _kept_or(df, "source_file_name", file_name),
        "source_system": _kept_or(df, "source_system", F.lit(source_system)),
        "ingestion_timestamp": stamp,
    }
    if batch_id:
        columns["batch_id"] = F.lit(batch_id)
    elif fallback_batch_id:
        columns["batch_id"] = _kept_or(df, "batch_id", F.lit(fallback_batch_id))
    return df.withColumns(columns)


def overwrite_lineage(
    df: DataFrame,
    *,
    source_system: str,
    file_name: Column,
    batch_id: str,
    now: Column | None = None,
) -> DataFrame:
    """Set all four lineage columns, whatever the feed says."""
    return df.withColumns(
        {
            "source_file_name": file_name,
            "source_system": F.lit(source_system),
            "ingestion_timestamp": F.current_timestamp() if now is None else now,
            "batch_id": F.lit(batch_id),
        }
    )
