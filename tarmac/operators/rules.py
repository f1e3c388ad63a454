"""Ordered quality rules: the first rule a row breaks names the reason."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``broken`` is a SQL condition; NULL counts as not broken."""

    reason: str
    broken: str


# Reason codes and the order in which they are tried.
FLIGHT_RULES = (
    Rule("MISSING_FLIGHT_NUMBER", "nullif(flight_number, '') is null"),
    Rule(
        "MISSING_AIRPORT_CODE",
        "nullif(origin_airport, '') is null or nullif(dest_airport, '') is null",
    ),
    Rule("INVALID_ROUTE", "origin_airport = dest_airport"),
    Rule("INVALID_SCHEDULED_DEPARTURE", "scheduled_departure_ts is null"),
    Rule("INVALID_SCHEDULED_ARRIVAL", "scheduled_arrival_ts is null"),
    Rule("MISSING_ACTUAL_DEPARTURE", "not cancelled_flag and actual_departure_ts is null"),
    Rule("MISSING_ACTUAL_ARRIVAL", "not cancelled_flag and actual_arrival_ts is null"),
)

# An optional rule that depends on another table, see ``with_known_airports``.
KNOWN_AIRPORTS = Rule("UNKNOWN_AIRPORT", "not (origin_is_known and dest_is_known)")


def with_known_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Whether origin and destination are among the cleaned ``airports``; meets each distinct code once."""
    codes = airports.select(F.col("airport_iata_code").alias("code")).filter("code is not null").distinct()
    for end in ("origin", "dest"):
        known = codes.select(F.col("code").alias(f"{end}_airport"), F.lit(True).alias(f"{end}_is_known"))
        flights = flights.join(known, f"{end}_airport", "left")
        flights = flights.withColumn(f"{end}_is_known", F.coalesce(f"{end}_is_known", F.lit(False)))
    return flights


def first_broken(rules: Iterable[Rule]) -> Column:
    """Reason of the first broken rule, NULL for a sound row."""
    rules = list(rules)
    head, *rest = rules
    chain = F.when(F.expr(head.broken), F.lit(head.reason))
    return reduce(lambda c, r: c.when(F.expr(r.broken), F.lit(r.reason)), rest, chain)


def split_on(df: DataFrame, reason: str = "quality_issue_reason") -> tuple[DataFrame, DataFrame]:
    """(sound rows, rows with a reason)."""
    return df.filter(F.col(reason).isNull()), df.filter(F.col(reason).isNotNull())
