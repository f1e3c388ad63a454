"""Validation checks as data: one row per check with what was seen and what was expected."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.codes import CANCELLATION_REASONS, is_blank
from tarmac.plans.gold import REPORTS
from tarmac.plans.silver import FLIGHT_KEY
from tarmac.schemas import TABLES
from tarmac.sinks.lake import Lake

ROUTE_KEY = ("flight_date", "route_code", "origin_airport", "dest_airport", "reporting_airline")


class CheckFailed(Exception):
    """A gate found checks that did not pass."""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def side_by_side(totals: Mapping[str, DataFrame]) -> DataFrame:
    """One row with a column per one-row, one-column total."""
    labelled = [
        df.select(F.lit(name).alias("side"), F.col(df.columns[0]).cast("bigint").alias("total"))
        for name, df in totals.items()
    ]
    sides = [F.max(F.when(F.col("side") == name, F.col("total"))).alias(name) for name in totals]
    return _union(labelled).agg(*sides)


def count_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def status(observed: Column, expected: Column) -> Column:
    """PASS when as expected, CHECK when not, INFO when nothing is expected."""
    return (
        F.when(expected.isNull(), "INFO").when(observed == expected, "PASS").otherwise("CHECK")
    )


def as_rows(totals: DataFrame, layer: str, expected: Mapping[str, int | Column | None]) -> DataFrame:
    """A one-row frame of counters as check rows; unnamed counters are expected to be zero."""

    def row(name: str) -> Column:
        want = expected.get(name, 0)
        want = want if isinstance(want, Column) else F.lit(want).cast("bigint")
        seen = F.col(name).cast("bigint")
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(layer).alias("layer"),
            seen.alias("observed"),
            want.alias("expected"),
            status(seen, want).alias("status"),
        )

    return totals.select(F.inline(F.array(*[row(c) for c in totals.columns])))


def expect_counts(tables: Mapping[str, DataFrame], layer: str, want: Mapping[str, int]) -> DataFrame:
    """Row counts against expected volumes; tables without one are informational."""
    counts = layer_counts(tables)
    pairs = [F.lit(x) for pair in want.items() for x in pair]
    expected = F.try_element_at(F.create_map(*pairs), F.col("table_name")) if pairs else F.lit(None)
    return counts.select(
        F.concat_ws(" ", F.lit("rows of"), "table_name").alias("check"),
        F.lit(layer).alias("layer"),
        F.col("row_count").alias("observed"),
        expected.cast("bigint").alias("expected"),
        status(F.col("row_count"), expected).alias("status"),
    )


# ---- single checks -------------------------------------------------------------------------


def missing_identifiers(raw_flights: DataFrame) -> DataFrame:
    """Blank identifiers in the raw flights, counted in one pass."""
    fields = {"flight_number": "flight_number", "origin": "origin_airport", "dest": "dest_airport"}
    return raw_flights.agg(
        *[F.count_if(is_blank(F.col(c))).alias(f"missing_{n}") for n, c in fields.items()]
    )


def duplicate_keys(raw_flights: DataFrame) -> DataFrame:
    """Flight keys that occur more than once, most frequent first."""
    return (
        raw_flights.groupBy(*FLIGHT_KEY)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter("duplicate_count > 1")
        .orderBy(F.desc("duplicate_count"))
    )


def _sequence_counters() -> list[Column]:
    return [
        F.count_if(F.col("scheduled_arrival_ts") < F.col("scheduled_departure_ts")).alias(
            "invalid_scheduled_sequence"
        ),
        F.count_if(F.col("actual_arrival_ts") < F.col("actual_departure_ts")).alias(
            "invalid_actual_sequence"
        ),
        F.count_if(
            F.col("route_code") != F.concat("origin_airport", F.lit("-"), "dest_airport")
        ).alias("invalid_route_code"),
    ]


def sequence_checks(flights: DataFrame) -> DataFrame:
    """Arrivals before departures and route codes that do not match, in one pass."""
    return flights.agg(*_sequence_counters())


def unmatched_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights whose origin or destination is not a known airport.

    Flights are counted per airport and role before the anti-join, which then sees one row
    per code however the flights are spread.
    """
    used = (
        flights.select(
            F.inline(
                F.array(
                    F.struct(F.lit("origin").alias("role"), F.col("origin_airport").alias("code")),
                    F.struct(F.lit("dest").alias("role"), F.col("dest_airport").alias("code")),
                )
            )
        )
        .groupBy("role", "code")
        .agg(F.count(F.lit(1)).alias("flights"))
    )
    known = airports.select(F.col("airport_iata_code").alias("code")).distinct()
    missing = used.join(known, "code", "left_anti")
    return missing.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("role") == r, F.col("flights"))), F.lit(0)).alias(
                f"unmatched_{r}_airports"
            )
            for r in ("origin", "dest")
        ]
    )


def _bad_percentage() -> Column:
    outside = ~F.col("on_time_arrival_percentage").between(0, 100)
    return F.count_if(outside).alias("invalid_on_time_percentage")


def bad_percentages(on_time: DataFrame) -> DataFrame:
    return on_time.agg(_bad_percentage())


def _code_counters() -> list[Column]:
    code = F.col("cancellation_code")
    known = F.coalesce(code.isin(list(CANCELLATION_REASONS)), F.lit(False))
    return [
        F.count_if(F.col("cancelled_flag") & ~known).alias("cancelled_without_reason"),
        F.count_if(~F.col("cancelled_flag") & code.isNotNull()).alias("reason_without_cancellation"),
    ]


def unknown_cancellation_codes(flights: DataFrame) -> DataFrame:
    """Cancelled flights without a published cancellation code, and codes on flown flights."""
    return flights.agg(*_code_counters())


def processed_totals(flights: DataFrame, quarantine: DataFrame) -> DataFrame:
    both = side_by_side({"clean_count": count_of(flights), "quarantine_count": count_of(quarantine)})
    return both.withColumn(
        "total_processed_count", F.col("clean_count") + F.col("quarantine_count")
    )


def reconcile_cancellations(flights: DataFrame, cancelled: DataFrame) -> DataFrame:
    return side_by_side(
        {
            "gold_cancellations": cancelled.agg(
                F.coalesce(F.sum("cancellation_count"), F.lit(0)).alias("n")
            ),
            "silver_cancelled_flights": flights.agg(F.count_if("cancelled_flag").alias("n")),
        }
    )


def reconcile_routes(flights: DataFrame, routes: DataFrame) -> DataFrame:
    return side_by_side(
        {
            "gold_route_rows": count_of(routes),
            "expected_route_rows": count_of(flights.select(*ROUTE_KEY).distinct()),
        }
    )


def reconcile_airports(flights: DataFrame, airport_rows: DataFrame) -> DataFrame:
    """Airport rows against the departure groups plus the arrival groups of the flights."""

    def groups(airport: str) -> DataFrame:
        return flights.select(
            "flight_date", F.col(airport).alias("airport_code"), "reporting_airline"
        ).distinct()

    expected = groups("origin_airport").unionByName(groups("dest_airport"))
    return side_by_side(
        {"gold_airport_rows": count_of(airport_rows), "expected_airport_rows": count_of(expected)}
    )


def on_time_sample(on_time: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows by date and airline."""
    return on_time.orderBy("flight_date", "reporting_airline").limit(rows)


# ---- all counters of a table in one pass ---------------------------------------------------

FLIGHT_COUNTERS = (
    "invalid_scheduled_sequence",
    "invalid_actual_sequence",
    "invalid_route_code",
    "cancelled_without_reason",
    "reason_without_cancellation",
    "unmatched_origin_airports",
    "unmatched_dest_airports",
)


def sum_of(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a + b, map(F.col, columns))


def one_row(frames: list[DataFrame]) -> DataFrame:
    """The columns of one-row frames of counters side by side."""
    labelled = [
        df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("label"), F.col(c).cast("bigint").alias("total"))
                        for c in df.columns
                    ]
                )
            )
        )
        for df in frames
    ]
    names = [c for df in frames for c in df.columns]
    return _union(labelled).agg(
        *[F.max(F.when(F.col("label") == n, F.col("total"))).alias(n) for n in names]
    )


def raw_totals(raw_flights: DataFrame) -> DataFrame:
    """Rows, blank identifiers and repeated keys of the raw flights."""
    fields = {"flight_number": "flight_number", "origin": "origin_airport", "dest": "dest_airport"}
    missing = [f"missing_{n}" for n in fields]
    per_key = raw_flights.groupBy(*FLIGHT_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(is_blank(F.col(c))).alias(n) for n, c in zip(missing, fields.values(), strict=True)],
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("flight_operations_raw"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in missing],
    )


def flight_totals(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Every counter of the cleaned flights from one scan.

    The flights are counted per day, route and airline; airports are looked up, and groups of
    the reports counted, on that much smaller result.
    """
    groups = flights.groupBy(*ROUTE_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("cancelled_flag").alias("cancelled"),
        *_sequence_counters(),
        *_code_counters(),
    )
    for role in ("origin", "dest"):
        known = airports.select(F.col("airport_iata_code").alias(f"{role}_airport")).distinct()
        known = known.withColumn(f"{role}_known", F.lit(True))
        groups = groups.join(known, f"{role}_airport", "left")
    day, airline = F.col("flight_date"), F.col("reporting_airline")

    def airports_in(role: str) -> Column:
        return F.count_distinct(F.struct(day, F.col(f"{role}_airport"), airline))

    def unmatched(role: str) -> Column:
        return F.sum(F.when(F.col(f"{role}_known").isNull(), F.col("n")).otherwise(0))

    totals = groups.agg(
        F.sum("n").alias("flight_operations_clean"),
        F.sum("cancelled").alias("silver_cancelled_flights"),
        *[F.sum(c).alias(c) for c in FLIGHT_COUNTERS[:5]],
        *[unmatched(r).alias(f"unmatched_{r}_airports") for r in ("origin", "dest")],
        F.count(F.lit(1)).alias("route_groups"),
        (airports_in("origin") + airports_in("dest")).alias("airport_groups"),
    )
    return totals.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in totals.columns])


def _as_counts(totals: DataFrame) -> DataFrame:
    """(table_name, row_count) from one row of counters."""
    rows = [
        F.struct(F.lit(c).alias("table_name"), F.col(c).cast("bigint").alias("row_count"))
        for c in totals.columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def judged_counts(judged: DataFrame) -> DataFrame:
    """Row counts of the three tables that come from judged flights, from one scan of these."""
    sound = F.col("quality_issue_reason").isNull()
    route = F.struct("origin_airport", "dest_airport", "route_code")
    per_route = judged.groupBy(F.when(sound, route).alias("route")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("route").isNotNull()
    totals = per_route.agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("flight_operations_clean"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("flight_operations_quarantine"),
        F.count_if(known).alias("route_reference"),
    )
    return _as_counts(totals)


def report_counts(flights: DataFrame) -> DataFrame:
    """Row counts of the reporting tables from one scan of the flights, without building the tables."""

    def group(table: str, *names: str | Column) -> Column:
        parts = [F.col(n) if isinstance(n, str) else n for n in names]
        parts += [F.lit(None).cast("string")] * (3 - len(parts))
        return F.struct(F.lit(table).alias("report"), *[p.alias(f"k{i}") for i, p in enumerate(parts)])

    everywhere = [
        group("on_time_performance_daily"),
        group("route_delay_summary", "route_code", "origin_airport", "dest_airport"),
        group("airport_delay_summary", F.lit("DEPARTURE"), "origin_airport"),
        group("airport_delay_summary", F.lit("ARRIVAL"), "dest_airport"),
        group("aircraft_performance_summary", "tail_number"),
    ]
    cancelled = group("cancellation_summary", "origin_airport", "dest_airport", "cancellation_code")
    groups = F.filter(
        F.array(*everywhere, F.when(F.col("cancelled_flag"), cancelled)), lambda g: g.isNotNull()
    )
    distinct = flights.select("flight_date", "reporting_airline", F.inline(groups)).distinct()
    reports = [name.split(".")[1] for name in REPORTS]
    return _as_counts(distinct.agg(*[F.count_if(F.col("report") == r).alias(r) for r in reports]))


# ---- suites over a lake --------------------------------------------------------------------

# Volumes of the full synthetic feed.
FULL_FEED_VOLUMES = {
    "flight_operations_raw": 720,
    "airports_raw": 8,
    "aircraft_reference_raw": 4,
    "flight_operations_clean": 720,
    "flight_operations_quarantine": 0,
    "route_reference": 12,
    "on_time_performance_daily": 240,
    "route_delay_summary": 720,
    "airport_delay_summary": 1320,
}


def lake_layer(lake: Lake, layer: str, *, rejected: bool = False) -> dict[str, DataFrame]:
    """The tables of a layer by short name; the rejected ones only on request."""
    return {
        name.split(".")[1]: lake.read(name)
        for name, definition in TABLES.items()
        if definition.layer == layer and name.endswith("_rejected") == rejected
    }


def _counts(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [df.agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]


class _Row:
    """Checks on the columns of one row of counters."""

    def __init__(self) -> None:
        self.checks: list[Column] = []

    def add(self, check: str, layer: str, observed: Column, expected: Column | int | None) -> None:
        want = expected if isinstance(expected, Column) else F.lit(expected)
        seen, want = observed.cast("bigint"), want.cast("bigint")
        columns = {
            "check": F.lit(check),
            "layer": F.lit(layer),
            "observed": seen,
            "expected": want,
            "status": status(seen, want),
        }
        self.checks.append(F.struct(*[c.alias(n) for n, c in columns.items()]))

    def of(self, counters: DataFrame) -> DataFrame:
        return counters.select(F.inline(F.array(*self.checks)))


def run_checks(lake: Lake, volumes: Mapping[str, int] | None = None) -> DataFrame:
    """All checks of the three layers as (check, layer, observed, expected, status).

    Every table is scanned once: what is counted in it is folded into one aggregate.
    """
    want, rows = volumes or {}, _Row()
    bronze, clean, reports = (lake_layer(lake, x) for x in ("bronze", "silver", "gold"))
    rejected = lake_layer(lake, "bronze", rejected=True)
    raw = bronze.pop("flight_operations_raw")
    flights = clean.pop("flight_operations_clean")
    on_time, cancelled = (reports.pop(x) for x in ("on_time_performance_daily", "cancellation_summary"))
    seen = one_row(
        [
            raw_totals(raw),
            *_counts({**bronze, **rejected, **clean, **reports}),
            flight_totals(flights, clean["airports_clean"]),
            on_time.agg(F.count(F.lit(1)).alias("on_time_performance_daily"), _bad_percentage()),
            cancelled.agg(
                F.count(F.lit(1)).alias("cancellation_summary"),
                F.coalesce(F.sum("cancellation_count"), F.lit(0)).alias("gold_cancellations"),
            ),
        ]
    )
    layers = {
        "bronze": ["flight_operations_raw", *bronze, *rejected],
        "silver": ["flight_operations_clean", *clean],
        "gold": ["on_time_performance_daily", "cancellation_summary", *reports],
    }
    for layer, tables in layers.items():
        for name in tables:
            rows.add(f"rows of {name}", layer, F.col(name), want.get(name))
    for name in ("missing_flight_number", "missing_origin", "missing_dest", "duplicate_keys"):
        rows.add(name, "bronze", F.col(name), 0)
    both = {"clean_count": "flight_operations_clean", "quarantine_count": "flight_operations_quarantine"}
    for name, column in both.items():
        rows.add(name, "silver", F.col(column), None)
    rows.add("total_processed_count", "silver", sum_of(both.values()), None)
    for name in FLIGHT_COUNTERS:
        rows.add(name, "silver", F.col(name), 0)
    rows.add("invalid_on_time_percentage", "gold", F.col("invalid_on_time_percentage"), 0)
    pairs = {
        ("gold_cancellations", "silver_cancelled_flights"): ("gold_cancellations", "silver_cancelled_flights"),
        ("gold_route_rows", "expected_route_rows"): ("route_delay_summary", "route_groups"),
        ("gold_airport_rows", "expected_airport_rows"): ("airport_delay_summary", "airport_groups"),
    }
    for names, columns in pairs.items():
        for name, own, other in zip(names, columns, reversed(columns), strict=True):
            rows.add(name, "gold", F.col(own), F.col(other))
    return rows.of(seen)


# ---- gates before publishing ---------------------------------------------------------------


def silver_gate(judged: DataFrame, clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """What must hold of cleaned flights before they are published, each input scanned once.

    Every judged flight is in exactly one of the tables, no arrival precedes its departure, and routes have the
    code of their airports. Codes that are not published ones are reported only.
    """
    seen = one_row(
        [
            *_counts({"judged": judged, "quarantined": quarantine}),
            clean.agg(F.count(F.lit(1)).alias("clean"), *_sequence_counters(), *_code_counters()),
        ]
    )
    rows = _Row()
    rows.add("flights_clean_or_quarantined", "silver", sum_of(("clean", "quarantined")), F.col("judged"))
    for name in FLIGHT_COUNTERS[:3]:
        rows.add(name, "silver", F.col(name), 0)
    for name in FLIGHT_COUNTERS[3:5]:
        rows.add(name, "silver", F.col(name), None)
    return rows.of(seen)


def gold_gate(flights: DataFrame, reports: Mapping[str, DataFrame]) -> DataFrame:
    """Whether reports (by table name) account for every flight, before they are published."""
    rows = _Row()
    totals = [flights.agg(F.count(F.lit(1)).alias("flights"), F.count_if("cancelled_flag").alias("cancelled"))]
    for name, df in reports.items():
        short = name.split(".")[1]
        amount = "cancellation_count" if "cancellation_count" in df.columns else "total_flights"
        counters = [F.coalesce(F.sum(amount), F.lit(0)).alias(short)]
        if "on_time_arrival_percentage" in df.columns:
            counters.append(_bad_percentage())
            rows.add("invalid_on_time_percentage", "gold", F.col("invalid_on_time_percentage"), 0)
        totals.append(df.agg(*counters))
        each = {"cancellation_count": F.col("cancelled"), "total_flights": F.col("flights")}[amount]
        # A flight visits two airports.
        rows.add(f"flights in {short}", "gold", F.col(short), each * 2 if "airport_role" in df.columns else each)
    return rows.of(one_row(totals))


def gate(checks: DataFrame) -> None:
    """Raise when a check did not pass; the report is a few dozen rows."""
    failed = [r["check"] for r in checks.filter(F.col("status") == "CHECK").collect()]
    if failed:
        raise CheckFailed("checks not passed: " + ", ".join(failed))
