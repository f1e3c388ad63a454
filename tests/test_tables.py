"""Cleaned and reporting tables: golden results of the sample day and edge rows."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import AIRCRAFT, AIRPORTS, FLIGHTS, flight

from tarmac.operators.align import align
from tarmac.plans import checks, gold, silver
from tarmac.plans.weather import weather_at
from tarmac.schemas import TABLES


def raw(spark, table, rows):
    """Rows of a raw table; blanks are NULL as after the scan."""
    names = sorted({k for row in rows for k in row})
    texts = [
        tuple(None if row.get(n) in ("", None) else str(row[n]) for n in names) for row in rows
    ]
    df = spark.createDataFrame(texts, ", ".join(f"{n} string" for n in names))
    return align(df, TABLES[table].schema, lenient=True)


def flights_of(spark, rows):
    return raw(spark, "bronze.flight_operations_raw", rows)


@pytest.fixture(scope="module")
def judged(spark):
    return silver.judge_flights(flights_of(spark, FLIGHTS)).cache()


@pytest.fixture(scope="module")
def clean(judged):
    return silver.clean_flights(judged).cache()


def verdicts(spark, rows):
    got = silver.judge_flights(flights_of(spark, rows)).collect()
    return {r["flight_number"]: r["quality_issue_reason"] for r in got}


def test_sample_day_is_sound(judged, clean):
    assert clean.count() == 8
    assert silver.quarantined_flights(judged).count() == 0
    assert silver.route_reference(clean).count() == 8
    want = TABLES["silver.flight_operations_clean"].schema.fieldNames()[1:]
    assert clean.columns == want


def test_sample_times_and_flags(clean):
    rows = {r["flight_number"]: r for r in clean.collect()}
    at = lambda day, h, m: datetime(2025, 3, day, h, m)
    late = rows["13"]
    assert (late["scheduled_departure_ts"], late["scheduled_arrival_ts"]) == (at(1, 23, 30), at(2, 1, 30))
    assert (late["actual_departure_ts"], late["actual_arrival_ts"]) == (at(1, 23, 40), at(2, 1, 55))
    assert (late["is_delayed_flag"], late["is_on_time_arrival_flag"]) == (True, False)
    gone = rows["14"]
    assert gone["actual_departure_ts"] is None and gone["actual_arrival_ts"] is None
    assert not gone["is_on_time_arrival_flag"] and not gone["is_on_time_departure_flag"]
    assert rows["21"]["route_code"] == "WES-MID" and rows["21"]["arrival_delay_minutes"] == -10
    delayed = {n for n, r in rows.items() if r["is_delayed_flag"]}
    assert delayed == {"12", "13", "23"}


def test_on_time_performance_of_the_sample(clean):
    table = align(gold.on_time_performance(clean), TABLES["gold.on_time_performance_daily"].schema)
    got = {r["reporting_airline"]: tuple(r)[2:18] for r in table.collect()}
    d = Decimal
    assert got == {
        "X1": (4, 3, 1, 0, 1, 2, 2, 1, d("33.33"), d("15.00"), d("25.00"), 0, 0, 0, 0, 30),
        "Y2": (4, 3, 1, 0, 1, 1, 2, 2, d("66.67"), d("5.00"), d("7.00"), 0, 0, 0, 0, 12),
    }


def test_airport_delays_of_the_sample(clean):
    rows = gold.airport_delays(clean).collect()
    got = {(r["airport_code"], r["airport_role"], r["reporting_airline"]): r for r in rows}
    assert len(rows) == 12
    hub = got["NOR", "ARRIVAL", "X1"]
    assert (hub["total_flights"], hub["completed_flights"], hub["cancelled_flights"]) == (2, 1, 1)
    assert (hub["avg_delay_minutes"], hub["max_delay_minutes"], hub["delayed_flights"]) == (20.0, 40, 1)
    assert hub["total_late_aircraft_delay_minutes"] == 30
    assert got["WES", "DEPARTURE", "Y2"]["avg_delay_minutes"] == 7.5


def test_cancellations_of_the_sample(clean):
    got = {
        (r["origin_airport"], r["dest_airport"], r["cancellation_reason"], r["cancellation_count"])
        for r in gold.cancellations(clean).collect()
    }
    assert got == {("MID", "WES", "National Air System", 1), ("OST", "NOR", "Weather", 1)}


def test_routes_and_aircraft_of_the_sample(spark, clean):
    routes = {r["route_code"]: r for r in gold.route_delays(clean).collect()}
    assert len(routes) == 8 and routes["SUD-NOR"]["max_arrival_delay_minutes"] == 40
    assert routes["MID-WES"]["max_arrival_delay_minutes"] is None
    types = silver.clean_aircraft(raw(spark, "bronze.aircraft_reference_raw", AIRCRAFT))
    tails = gold.aircraft_performance(clean, types).collect()
    assert len(tails) == 8 and {r["aircraft_name"] for r in tails} == {None}
    assert {r["aircraft_code"] for r in tails if r["tail_number"] == "T101C3"} == {"01C3"}
    other = silver.clean_flights(silver.judge_flights(flights_of(spark, [flight()])))
    assert gold.aircraft_performance(other, types).first()["aircraft_name"] == "Invented Jet 7"


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"flight_number": ""}, "MISSING_FLIGHT_NUMBER"),
        ({"flight_number": "   "}, "MISSING_FLIGHT_NUMBER"),
        ({"origin_airport": None, "dest_airport": " "}, "MISSING_AIRPORT_CODE"),
        ({"origin_airport": " sud "}, "INVALID_ROUTE"),
        ({"crs_dep_time": "2400"}, "INVALID_SCHEDULED_DEPARTURE"),
        ({"crs_dep_time": "6100"}, "INVALID_SCHEDULED_DEPARTURE"),
        ({"crs_dep_time": None}, "INVALID_SCHEDULED_DEPARTURE"),
        ({"flight_date": None}, "INVALID_SCHEDULED_DEPARTURE"),
        ({"crs_arr_time": "9999"}, "INVALID_SCHEDULED_ARRIVAL"),
        ({"dep_time": ""}, "MISSING_ACTUAL_DEPARTURE"),
        ({"arr_time": "", "diverted": 1}, "MISSING_ACTUAL_ARRIVAL"),
        ({"flight_number": "", "crs_dep_time": "2400"}, "MISSING_FLIGHT_NUMBER"),
        ({"cancelled": None, "dep_time": ""}, None),
        ({"cancelled": 1, "dep_time": "", "arr_time": ""}, None),
    ],
)
def test_quality_rules(spark, change, reason):
    assert list(verdicts(spark, [flight(**change)]).values()) == [reason]


def test_payload_is_kept_for_quarantine_only(spark):
    judged = silver.judge_flights(flights_of(spark, [flight(), flight(flight_number="")]))
    bad = silver.quarantined_flights(judged).first()
    assert bad["raw_record"] and bad["raw_flight_date"] == "2025-03-01"
    assert judged.filter("quality_issue_reason is null").first()["raw_record"] is None


def test_rows_without_number_collapse_and_airline_is_taken_as_is(spark):
    rows = [flight(flight_number=None), flight(flight_number=None, taxi_in=3),
            flight(reporting_airline="ua", flight_number=None)]
    assert silver.judge_flights(flights_of(spark, rows)).count() == 2


def test_unknown_cancellation_and_delays(spark):
    rows = [
        flight(flight_number="1", cancelled=None, dep_time="", arr_time=""),
        flight(flight_number="2", arr_delay_minutes=15.9, dep_delay_minutes=-3.9),
        flight(flight_number="3", arr_delay_minutes=None, dep_delay_minutes=None),
    ]
    clean = silver.clean_flights(silver.judge_flights(flights_of(spark, rows)))
    got = {r["flight_number"]: r for r in clean.collect()}
    assert got["1"]["cancelled_flag"] is None
    assert (got["2"]["arrival_delay_minutes"], got["2"]["departure_delay_minutes"]) == (15, -3)
    assert got["3"]["is_on_time_arrival_flag"] and not got["3"]["is_delayed_flag"]
    day = gold.on_time_performance(clean).first()
    assert (day["total_flights"], day["completed_flights"], day["cancelled_flights"]) == (3, 2, 0)
    assert day["avg_arrival_delay_minutes"] == (21 + 15) / 2
    arrival = gold.airport_delays(clean).filter("airport_role = 'ARRIVAL'").first()
    assert arrival["avg_delay_minutes"] == (21 + 15 + 0) / 3


def test_all_cancelled_is_zero_percent_and_departure_is_never_rolled(spark):
    gone = flight(cancelled=1, cancellation_code="Z", dep_time="", arr_time="",
                  arr_delay_minutes=None, dep_delay_minutes=None)
    clean = silver.clean_flights(silver.judge_flights(flights_of(spark, [gone])))
    assert gold.on_time_performance(clean).first()["on_time_arrival_percentage"] == 0.0
    assert gold.cancellations(clean).first()["cancellation_reason"] == "Unknown"
    late = flight(crs_dep_time="2350", dep_time="0020", crs_arr_time="0150", arr_time="0225")
    row = silver.clean_flights(silver.judge_flights(flights_of(spark, [late]))).first()
    assert row["actual_departure_ts"] == datetime(2025, 3, 1, 0, 20)
    assert row["actual_arrival_ts"] == datetime(2025, 3, 1, 2, 25)
    assert row["scheduled_arrival_ts"] == datetime(2025, 3, 2, 1, 50)


def test_airports_in_any_case_are_one(spark):
    twin = {**AIRPORTS[0], "iata_code": "nor", "icao_code": "knor", "ident": "knor",
            "ingestion_timestamp": "2026-06-01T00:00:00", "scheduled_service": None}
    nameless = {**AIRPORTS[1], "iata_code": None, "icao_code": None}
    got = silver.clean_airports(raw(spark, "bronze.airports_raw", [*AIRPORTS, twin, nameless]))
    rows = {r["airport_iata_code"]: r for r in got.collect()}
    assert len(rows) == got.count() == 5
    assert rows["NOR"]["scheduled_service_flag"] is False and rows["SUD"]["scheduled_service_flag"]
    assert rows["NOR"]["iso_region"] == "US-XX"


def test_weather_is_cleaned_and_found_across_midnight(spark):
    obs = [
        ("knor", "2025-02-28 23:30:10", "ifr"), ("KNOR", "2025-02-28 23:30:10", "vfr"),
        ("KNOR", "2025-03-01 06:40:00", "lifr"), ("KNOR", "2025-03-01 06:41:00", "mvfr"),
        (None, "2025-03-01 06:00:00", "vfr"),
    ]
    rows = [
        {"station_id": s, "observation_time": t, "observation_date": t[:10],
         "flight_category": c, "record_hash": c}
        for s, t, c in obs
    ]
    weather = silver.clean_weather(raw(spark, "bronze.weather_metar_raw", rows))
    assert weather.count() == 3
    airports = silver.clean_airports(raw(spark, "bronze.airports_raw", AIRPORTS))
    flights = [
        flight(flight_number="night", crs_dep_time="0130"),
        flight(flight_number="old", crs_dep_time="0131"),
        flight(flight_number="exact"),
        flight(flight_number="none", origin_airport="XXX"),
    ]
    clean = silver.clean_flights(silver.judge_flights(flights_of(spark, flights)))
    got = {r["flight_number"]: r["flight_category"] for r in weather_at(clean, weather, airports).collect()}
    assert got == {"night": "VFR", "old": None, "exact": "LIFR", "none": None}


def test_checks_notice_what_is_wrong(spark, clean):
    airports = silver.clean_airports(raw(spark, "bronze.airports_raw", AIRPORTS[1:]))
    missing = checks.unmatched_airports(clean, airports).first()
    assert tuple(missing) == (2, 2)
    twice = flights_of(spark, [flight(), flight(), flight(flight_number=None)])
    assert [r["duplicate_count"] for r in checks.duplicate_keys(twice).collect()] == [2]
    assert tuple(checks.missing_identifiers(twice).first()) == (1, 0, 0)
    report = checks.expect_counts({"a": twice, "b": twice}, "bronze", {"a": 4})
    assert {r["check"]: r["status"] for r in report.collect()} == {"rows of a": "CHECK", "rows of b": "INFO"}
    with pytest.raises(checks.CheckFailed, match="rows of a"):
        checks.gate(report)
    checks.gate(report.filter(F.col("status") == "INFO"))
