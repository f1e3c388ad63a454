"""Export a feed as one folder of CSV and one of JSON Lines per month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_monthly(df: DataFrame, folder: str, month: str = "year_month") -> dict[str, str]:
    """Write ``df`` split by ``month``; returns the folder per format.

    The month stays in the rows as well, as the feeds carry it.
    """
    targets = {"csv": f"{folder.rstrip('/')}/csv", "json": f"{folder.rstrip('/')}/json"}
    split = df.withColumn("month", F.col(month)).hint("rebalance", "month")
    writer = split.write.mode("overwrite").partitionBy("month")
    writer.option("header", "true").option("escape", '"').csv(targets["csv"])
    writer.option("ignoreNullFields", "false").json(targets["json"])
    return targets
