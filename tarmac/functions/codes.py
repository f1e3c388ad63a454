"""Code normalisation and fixed code lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published cancellation codes and their meaning.
CANCELLATION_REASONS = {
    "A": "Carrier",
    "B": "Weather",
    "C": "National Air System",
    "D": "Security",
}
UNKNOWN_REASON = "Unknown"

# Fixed value: the aircraft code is the last two to four capitals or digits of the tail number.
TAIL_CODE_PATTERN = r"([A-Z0-9]{2,4})$"


def station_code(code: Column) -> Column:
    """Airport code without surrounding blanks, in capitals."""
    return F.upper(F.trim(code))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def tail_code(tail_number: Column) -> Column:
    """Aircraft code at the end of a tail number; empty when there is none."""
    return F.upper(F.regexp_extract(tail_number, TAIL_CODE_PATTERN, 1))


def cancellation_reason(code: Column) -> Column:
    """Readable reason for a cancellation code."""
    pairs = [F.lit(x) for pair in CANCELLATION_REASONS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(UNKNOWN_REASON))
