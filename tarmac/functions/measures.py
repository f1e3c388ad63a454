"""Aggregate measures shared by the reporting tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A flight counts as late when it is more than this many minutes behind schedule.
LATE_AFTER_MINUTES = 15


def known_minutes(column: str) -> Column:
    """Minutes with unknown taken as zero."""
    return F.coalesce(F.col(column), F.lit(0))


def is_late(column: str) -> Column:
    return known_minutes(column) > LATE_AFTER_MINUTES


def flight_counts() -> list[Column]:
    """Totals by outcome; a NULL flag is neither completed nor cancelled."""
    return [
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(~F.col("cancelled_flag")).alias("completed_flights"),
        F.count_if(F.col("cancelled_flag")).alias("cancelled_flights"),
    ]


def delay_states(*sides: str) -> list[Column]:
    """Sum and number of the known delays: what an average is made of."""
    return [
        agg(f"{side}_delay_minutes").alias(f"{name}_{side}_delay_minutes")
        for side in sides or ("departure", "arrival")
        for name, agg in (("sum", F.sum), ("known", F.count))
    ]


def averages_of(*sides: str) -> dict[str, Column]:
    """Averages from ``delay_states``; NULL where no delay is known."""
    return {
        f"avg_{side}_delay_minutes": F.try_divide(
            F.col(f"sum_{side}_delay_minutes").cast("double"), F.col(f"known_{side}_delay_minutes")
        )
        for side in sides or ("departure", "arrival")
    }


def merged(columns: list[str], keys: tuple[str, ...]) -> list[Column]:
    """Aggregates that merge stored sums, counts and maxima, told apart by name."""
    return [
        (F.max(c) if c.startswith("max_") else F.sum(c)).alias(c) for c in columns if c not in keys
    ]


def cause_totals(*causes: str) -> list[Column]:
    return [
        F.sum(known_minutes(f"{cause}_delay_minutes")).alias(f"total_{cause}_delay_minutes")
        for cause in causes
    ]
