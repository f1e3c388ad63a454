"""Reporting tables from the cleaned flights.

Every report is the finished form of a *state*: sums, counts and maxima per key. States of parts of the flights (days,
batches, any split) are merged by a second aggregate, so that averages and shares come out as from one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.codes import cancellation_reason, tail_code
from tarmac.functions.measures import (
    LATE_AFTER_MINUTES,
    averages_of,
    cause_totals,
    delay_states,
    flight_counts,
    is_late,
    known_minutes,
    merged,
)


class Report(NamedTuple):
    """How a report's state is made, by which keys it is merged and how it is finished."""

    keys: tuple[str, ...]
    state: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]


def merge_states(states: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One state per ``keys`` (the report's own or fewer) from any number of states."""
    return states.groupBy(*keys).agg(*merged(states.columns, keys))


def _on_time_state(flights: DataFrame) -> DataFrame:
    return flights.groupBy("flight_date", "reporting_airline").agg(
        *flight_counts(),
        F.count_if("diverted_flag").alias("diverted_flights"),
        F.count_if(is_late("departure_delay_minutes")).alias("delayed_departure_flights"),
        F.count_if(is_late("arrival_delay_minutes")).alias("delayed_arrival_flights"),
        F.count_if("is_on_time_departure_flag").alias("on_time_departure_flights"),
        F.count_if("is_on_time_arrival_flag").alias("on_time_arrival_flights"),
        *delay_states(),
        *cause_totals("weather", "carrier", "nas", "security", "late_aircraft"),
    )


def _without_parts(df: DataFrame, *sides: str) -> DataFrame:
    names = [f"{part}_{s}_delay_minutes" for s in sides or ("departure", "arrival") for part in ("sum", "known")]
    return df.withColumns(averages_of(*sides)).drop(*names)


def _finish_on_time(state: DataFrame) -> DataFrame:
    share = F.try_divide(F.col("on_time_arrival_flights") * 100.0, F.col("completed_flights"))
    finished = _without_parts(state)
    return finished.withColumn("on_time_arrival_percentage", F.coalesce(share, F.lit(0.0)))


def _delay_profile(flights: DataFrame, *keys: str) -> DataFrame:
    return flights.groupBy(*keys).agg(
        *flight_counts(),
        F.count_if(is_late("arrival_delay_minutes")).alias("delayed_arrival_flights"),
        *delay_states(),
        F.max("arrival_delay_minutes").alias("max_arrival_delay_minutes"),
        *cause_totals("weather", "carrier", "late_aircraft"),
    )


def _airport_state(flights: DataFrame) -> DataFrame:
    """Each flight yields a departure and an arrival row inside one scan; unknown delays count as zero here."""
    causes = ("weather", "carrier", "late_aircraft")

    def visit(role: str, airport: str, side: str) -> Column:
        return F.struct(
            F.lit(role).alias("airport_role"),
            F.col(airport).alias("airport_code"),
            known_minutes(f"{side}_delay_minutes").alias("delay_minutes"),
            F.col(f"is_on_time_{side}_flag").alias("on_time_flag"),
        )

    visits = flights.select(
        "flight_date",
        "reporting_airline",
        "cancelled_flag",
        *[f"{c}_delay_minutes" for c in causes],
        F.inline(
            F.array(
                visit("DEPARTURE", "origin_airport", "departure"),
                visit("ARRIVAL", "dest_airport", "arrival"),
            )
        ),
    )
    return visits.groupBy("flight_date", "airport_code", "airport_role", "reporting_airline").agg(
        *flight_counts(),
        F.count_if(F.col("delay_minutes") > LATE_AFTER_MINUTES).alias("delayed_flights"),
        F.count_if("on_time_flag").alias("on_time_flights"),
        F.sum("delay_minutes").alias("sum_delay_minutes"),
        F.max("delay_minutes").alias("max_delay_minutes"),
        *cause_totals(*causes),
    )


def _finish_airports(state: DataFrame) -> DataFrame:
    average = F.col("sum_delay_minutes").cast("double") / F.col("total_flights")
    return state.withColumn("avg_delay_minutes", average).drop("sum_delay_minutes")


CANCELLATION_KEYS = (
    "flight_date",
    "reporting_airline",
    "origin_airport",
    "dest_airport",
    "cancellation_code",
)


def _cancellation_state(flights: DataFrame) -> DataFrame:
    cancelled = flights.filter("cancelled_flag")
    return cancelled.groupBy(*CANCELLATION_KEYS).agg(F.count(F.lit(1)).alias("cancellation_count"))


ROUTE_KEYS = ("flight_date", "route_code", "origin_airport", "dest_airport", "reporting_airline")
TAIL_KEYS = ("flight_date", "tail_number", "reporting_airline")

REPORTS: dict[str, Report] = {
    "gold.on_time_performance_daily": Report(
        ("flight_date", "reporting_airline"), _on_time_state, _finish_on_time
    ),
    "gold.route_delay_summary": Report(
        ROUTE_KEYS, lambda flights: _delay_profile(flights, *ROUTE_KEYS), _without_parts
    ),
    "gold.airport_delay_summary": Report(
        ("flight_date", "airport_code", "airport_role", "reporting_airline"),
        _airport_state,
        _finish_airports,
    ),
    "gold.cancellation_summary": Report(
        CANCELLATION_KEYS,
        _cancellation_state,
        lambda state: state.withColumn(
            "cancellation_reason", cancellation_reason(F.col("cancellation_code"))
        ),
    ),
    "gold.aircraft_performance_summary": Report(
        TAIL_KEYS, lambda flights: _delay_profile(flights, *TAIL_KEYS), _without_parts
    ),
}


def _stamped(df: DataFrame, now: Column | None) -> DataFrame:
    return df.withColumn("load_timestamp", F.current_timestamp() if now is None else now)


def _report(name: str, flights: DataFrame, now: Column | None) -> DataFrame:
    report = REPORTS[name]
    return _stamped(report.finish(report.state(flights)), now)


def merged_report(name: str, parts: list[DataFrame], now: Column | None = None) -> DataFrame:
    """A report from the states of several parts of the flights."""
    report = REPORTS[name]
    states = parts[0]
    for more in parts[1:]:
        states = states.unionByName(more)
    return _stamped(report.finish(merge_states(states, report.keys)), now)


def on_time_performance(flights: DataFrame, now: Column | None = None) -> DataFrame:
    """Punctuality per day and airline."""
    return _report("gold.on_time_performance_daily", flights, now)


def monthly_punctuality(daily: DataFrame) -> DataFrame:
    """Punctuality per month and airline, merged from the daily states without the flights."""
    months = daily.withColumn("year_month", F.date_format("flight_date", "yyyy-MM")).drop("flight_date")
    return _finish_on_time(merge_states(months, ("year_month", "reporting_airline")))


def route_delays(flights: DataFrame, now: Column | None = None) -> DataFrame:
    """Delays per day, route and airline."""
    return _report("gold.route_delay_summary", flights, now)


def airport_delays(flights: DataFrame, now: Column | None = None) -> DataFrame:
    """Delays per day, airport, role and airline."""
    return _report("gold.airport_delay_summary", flights, now)


def cancellations(flights: DataFrame, now: Column | None = None) -> DataFrame:
    """Cancelled flights per day, airline, route and code."""
    return _report("gold.cancellation_summary", flights, now)


def with_aircraft_names(per_tail: DataFrame, aircraft: DataFrame) -> DataFrame:
    """The aircraft type where it is known; ``aircraft`` holds each code once.

    The type depends on the tail number alone, so the flights are aggregated first and the
    names joined to the much smaller result. Codes have four characters at most and a few hold
    most flights: the names are broadcast, so that no task gets all flights of a code.
    """
    names = aircraft.select(F.upper("aircraft_code").alias("aircraft_code"), "aircraft_name")
    typed = per_tail.withColumn("aircraft_code", tail_code(F.col("tail_number")))
    return typed.join(F.broadcast(names), "aircraft_code", "left")


def aircraft_performance(
    flights: DataFrame, aircraft: DataFrame, now: Column | None = None
) -> DataFrame:
    """Delays per day, tail number and airline, with the aircraft type where it is known."""
    return with_aircraft_names(_report("gold.aircraft_performance_summary", flights, now), aircraft)
