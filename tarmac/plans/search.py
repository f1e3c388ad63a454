"""Find tables by name.

Works on any frame of (catalog, schema, table, table_type, source_rank), where source rank 0 is
the primary catalog and 1 a secondary one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import TABLES
from tarmac.sinks.lake import Lake

MATCH_COLUMNS = ("catalog", "schema", "table", "table_type")
_LISTING = "catalog STRING, schema STRING, table STRING, table_type STRING, source_rank INT"


def _needle(name: str) -> str:
    cleaned = name.strip().lower()
    if not cleaned:
        raise ValueError("the name to look for is blank")
    return cleaned


def _match_score(needle: str) -> Column:
    """0 exact, 1 prefix, 2 elsewhere."""
    table = F.lower("table")
    return F.when(table == needle, 0).when(table.startswith(needle), 1).otherwise(2)


def _listing_order(needle: str) -> list[Column]:
    """Primary matches by score, then secondary ones in listing order."""
    score = F.when(F.col("source_rank") == 0, _match_score(needle)).otherwise(0)
    return [F.col("source_rank"), score, F.col("catalog"), F.col("schema"), F.col("table")]


def search_tables(
    tables: DataFrame,
    name: str,
    *,
    exact: bool = False,
    include_secondary: bool = False,
    limit: int = 20,
) -> DataFrame:
    """Up to ``limit`` matches in rank order, ignoring case."""
    needle = _needle(name)
    table = F.lower("table")
    hits = tables.filter(table == needle if exact else table.contains(needle))
    if not include_secondary:
        hits = hits.filter(F.col("source_rank") == 0)
    return hits.orderBy(*_listing_order(needle)).limit(limit).select(*MATCH_COLUMNS)


def best_match(tables: DataFrame, name: str, *, include_secondary: bool = False) -> DataFrame:
    """At most one row with the ``full_path`` of the best match; any exact hit comes first."""
    needle = _needle(name)
    hits = tables.filter(F.lower("table").contains(needle))
    if not include_secondary:
        hits = hits.filter(F.col("source_rank") == 0)
    inexact = (F.lower("table") != needle).cast("int")
    best = hits.orderBy(inexact, *_listing_order(needle)).limit(1)
    return best.select(F.concat_ws(".", "catalog", "schema", "table").alias("full_path"))


def catalog_tables(spark: SparkSession, *, source_rank: int = 0) -> DataFrame:
    """Tables and views of the session catalog, temporary views included."""
    catalog = spark.catalog.currentCatalog()
    rows = [
        (catalog, ".".join(t.namespace or ()), t.name, t.tableType, source_rank)
        for database in spark.catalog.listDatabases()
        for t in spark.catalog.listTables(database.name)
        if database.name != "information_schema"
    ]
    return spark.createDataFrame(rows, _LISTING).distinct()


def lake_tables(lake: Lake, *, source_rank: int = 0, catalog: str = "lake") -> DataFrame:
    """The tables that exist in a lake."""
    rows = [
        (catalog, *name.split("."), "MANAGED", source_rank)
        for name in TABLES
        if lake.table(name).exists()
    ]
    return lake.spark.createDataFrame(rows, _LISTING)
