"""Declared tables: columns, partitioning and generated keys.

The column lists are fixed values: names, types and order are the public
contract of every table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableDef:
    """One declared table of the lake, addressed as ``layer.table``."""

    name: str
    columns: str
    # May name columns that exist in the files only; they are not part of the table.
    partition_by: tuple[str, ...] = ()
    key: str | None = None
    # SQL for partition columns that must agree with another column, whatever a feed says.
    derived: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def layer(self) -> str:
        return self.name.split(".", 1)[0]


REJECTED_COLUMNS = """
    source_table STRING, source_system STRING, source_file_name STRING, rescued_data STRING,
    raw_payload STRING, batch_id STRING, rejection_timestamp TIMESTAMP
"""

AUDIT = TableDef(
    "audit.pipeline_run_log",
    """
    event_timestamp TIMESTAMP, pipeline_name STRING, stage_name STRING, target_table STRING,
    run_id STRING, batch_id STRING, status STRING, rows_written BIGINT, rows_removed BIGINT,
    rows_rescued BIGINT, restored_version BIGINT, error_message STRING, details STRING
    """,
)

_DEFS = [
    # ---- bronze: raw feeds as delivered, typed, with lineage -------------------------------
    TableDef(
        "bronze.flight_operations_raw",
        """
        flight_date DATE, reporting_airline STRING, reporting_airline_name STRING,
        tail_number STRING, flight_number STRING, origin_airport STRING,
        origin_airport_seq_id STRING, origin_city_name STRING, origin_state_abbr STRING,
        dest_airport STRING, dest_airport_seq_id STRING, dest_city_name STRING,
        dest_state_abbr STRING, crs_dep_time STRING, dep_time STRING, dep_delay_minutes DOUBLE,
        taxi_out DOUBLE, wheels_off STRING, wheels_on STRING, taxi_in DOUBLE,
        crs_arr_time STRING, arr_time STRING, arr_delay_minutes DOUBLE, cancelled INT,
        cancellation_code STRING, diverted INT, distance_miles DOUBLE, carrier_delay DOUBLE,
        weather_delay DOUBLE, nas_delay DOUBLE, security_delay DOUBLE,
        late_aircraft_delay DOUBLE, raw_record STRING, source_file_name STRING,
        source_system STRING, ingestion_timestamp TIMESTAMP, batch_id STRING,
        record_hash STRING, year_month STRING
        """,
        ("batch_id", "year_month"),
        derived=(("year_month", "date_format(flight_date, 'yyyy-MM')"),),
    ),
    TableDef(
        "bronze.airports_raw",
        """
        airport_id STRING, ident STRING, type STRING, name STRING, latitude_deg DOUBLE,
        longitude_deg DOUBLE, elevation_ft DOUBLE, continent STRING, iso_country STRING,
        iso_region STRING, municipality STRING, scheduled_service STRING, gps_code STRING,
        icao_code STRING, iata_code STRING, local_code STRING, home_link STRING,
        wikipedia_link STRING, keywords STRING, raw_record STRING, source_file_name STRING,
        source_system STRING, ingestion_timestamp TIMESTAMP, batch_id STRING,
        record_hash STRING
        """,
        ("batch_id",),
    ),
    TableDef(
        "bronze.aircraft_reference_raw",
        """
        aircraft_code STRING, aircraft_name STRING, iata_code STRING, icao_code STRING,
        raw_record STRING, source_file_name STRING, source_system STRING,
        ingestion_timestamp TIMESTAMP, batch_id STRING, record_hash STRING
        """,
        ("batch_id",),
    ),
    TableDef(
        "bronze.weather_metar_raw",
        """
        station_id STRING, observation_time TIMESTAMP, raw_text STRING, temp_c DOUBLE,
        dewpoint_c DOUBLE, wind_dir_degrees INT, wind_speed_kt DOUBLE, wind_gust_kt DOUBLE,
        visibility_statute_mi DOUBLE, altim_in_hg DOUBLE, flight_category STRING,
        precip_in DOUBLE, sky_cover STRING, raw_record STRING, source_file_name STRING,
        source_system STRING, ingestion_timestamp TIMESTAMP, batch_id STRING,
        record_hash STRING, observation_date DATE
        """,
        ("batch_id", "observation_date"),
        derived=(("observation_date", "cast(observation_time as date)"),),
    ),
    TableDef("bronze.flight_operations_rejected", REJECTED_COLUMNS, ("batch_id",)),
    TableDef("bronze.airports_rejected", REJECTED_COLUMNS, ("batch_id",)),
    TableDef("bronze.aircraft_reference_rejected", REJECTED_COLUMNS, ("batch_id",)),
    TableDef("bronze.weather_metar_rejected", REJECTED_COLUMNS, ("batch_id",)),
    # ---- silver: cleaned, one row per business key -----------------------------------------
    TableDef(
        "silver.airports_clean",
        """
        airport_key BIGINT, airport_iata_code STRING, airport_icao_code STRING,
        airport_ident STRING, airport_name STRING, airport_type STRING, municipality STRING,
        iso_country STRING, iso_region STRING, continent STRING, latitude_deg DOUBLE,
        longitude_deg DOUBLE, elevation_ft DOUBLE, scheduled_service_flag BOOLEAN,
        ingestion_timestamp TIMESTAMP, batch_id STRING
        """,
        key="airport_key",
    ),
    TableDef(
        "silver.aircraft_reference_clean",
        """
        aircraft_key BIGINT, aircraft_code STRING, aircraft_name STRING, iata_code STRING,
        icao_code STRING, ingestion_timestamp TIMESTAMP, batch_id STRING
        """,
        key="aircraft_key",
    ),
    TableDef(
        "silver.route_reference",
        """
        route_key BIGINT, origin_airport STRING, dest_airport STRING, route_code STRING,
        route_group STRING, first_seen_flight_date DATE, last_seen_flight_date DATE,
        total_record_count BIGINT, ingestion_timestamp TIMESTAMP, batch_id STRING
        """,
        key="route_key",
    ),
    TableDef(
        "silver.weather_observations_clean",
        """
        weather_key BIGINT, station_id STRING, observation_time TIMESTAMP,
        observation_date DATE, temp_c DOUBLE, dewpoint_c DOUBLE, wind_dir_degrees INT,
        wind_speed_kt DOUBLE, wind_gust_kt DOUBLE, visibility_statute_mi DOUBLE,
        altim_in_hg DOUBLE, flight_category STRING, precip_in DOUBLE, sky_cover STRING,
        ingestion_timestamp TIMESTAMP, batch_id STRING
        """,
        ("observation_date",),
        "weather_key",
    ),
    TableDef(
        "silver.flight_operations_clean",
        """
        flight_operation_key BIGINT, flight_date DATE, reporting_airline STRING,
        reporting_airline_name STRING, tail_number STRING, flight_number STRING,
        origin_airport STRING, dest_airport STRING, route_code STRING,
        origin_city_name STRING, origin_state_abbr STRING, dest_city_name STRING,
        dest_state_abbr STRING, scheduled_departure_ts TIMESTAMP,
        actual_departure_ts TIMESTAMP, scheduled_arrival_ts TIMESTAMP,
        actual_arrival_ts TIMESTAMP, departure_delay_minutes INT, arrival_delay_minutes INT,
        taxi_out_minutes INT, taxi_in_minutes INT, cancelled_flag BOOLEAN,
        cancellation_code STRING, diverted_flag BOOLEAN, distance_miles DOUBLE,
        carrier_delay_minutes INT, weather_delay_minutes INT, nas_delay_minutes INT,
        security_delay_minutes INT, late_aircraft_delay_minutes INT, is_delayed_flag BOOLEAN,
        is_on_time_arrival_flag BOOLEAN, is_on_time_departure_flag BOOLEAN,
        processing_status STRING, quality_issue_reason STRING, ingestion_timestamp TIMESTAMP,
        batch_id STRING, source_file_name STRING, record_hash STRING, year_month STRING
        """,
        ("year_month",),
        "flight_operation_key",
    ),
    TableDef(
        "silver.flight_operations_quarantine",
        """
        quarantine_key BIGINT, raw_flight_date STRING, reporting_airline STRING,
        flight_number STRING, origin_airport STRING, dest_airport STRING,
        quality_issue_reason STRING, raw_record STRING, source_file_name STRING,
        ingestion_timestamp TIMESTAMP, batch_id STRING, record_hash STRING
        """,
        ("year_month",),
        "quarantine_key",
    ),
    # ---- gold: reporting aggregates --------------------------------------------------------
    TableDef(
        "gold.on_time_performance_daily",
        """
        flight_date DATE, reporting_airline STRING, total_flights BIGINT,
        completed_flights BIGINT, cancelled_flights BIGINT, diverted_flights BIGINT,
        delayed_departure_flights BIGINT, delayed_arrival_flights BIGINT,
        on_time_departure_flights BIGINT, on_time_arrival_flights BIGINT,
        on_time_arrival_percentage DECIMAL(9,2), avg_departure_delay_minutes DECIMAL(9,2),
        avg_arrival_delay_minutes DECIMAL(9,2), total_weather_delay_minutes BIGINT,
        total_carrier_delay_minutes BIGINT, total_nas_delay_minutes BIGINT,
        total_security_delay_minutes BIGINT, total_late_aircraft_delay_minutes BIGINT,
        load_timestamp TIMESTAMP
        """,
        ("flight_date",),
    ),
    TableDef(
        "gold.route_delay_summary",
        """
        flight_date DATE, route_code STRING, origin_airport STRING, dest_airport STRING,
        reporting_airline STRING, total_flights BIGINT, completed_flights BIGINT,
        cancelled_flights BIGINT, delayed_arrival_flights BIGINT,
        avg_departure_delay_minutes DECIMAL(9,2), avg_arrival_delay_minutes DECIMAL(9,2),
        max_arrival_delay_minutes INT, total_weather_delay_minutes BIGINT,
        total_carrier_delay_minutes BIGINT, total_late_aircraft_delay_minutes BIGINT,
        load_timestamp TIMESTAMP
        """,
        ("flight_date",),
    ),
    TableDef(
        "gold.airport_delay_summary",
        """
        flight_date DATE, airport_code STRING, airport_role STRING, reporting_airline STRING,
        total_flights BIGINT, completed_flights BIGINT, cancelled_flights BIGINT,
        delayed_flights BIGINT, on_time_flights BIGINT, avg_delay_minutes DECIMAL(9,2),
        max_delay_minutes INT, total_weather_delay_minutes BIGINT,
        total_carrier_delay_minutes BIGINT, total_late_aircraft_delay_minutes BIGINT,
        load_timestamp TIMESTAMP
        """,
        ("flight_date",),
    ),
    TableDef(
        "gold.cancellation_summary",
        """
        flight_date DATE, reporting_airline STRING, origin_airport STRING,
        dest_airport STRING, cancellation_code STRING, cancellation_reason STRING,
        cancellation_count BIGINT, load_timestamp TIMESTAMP
        """,
        ("flight_date",),
    ),
    TableDef(
        "gold.aircraft_performance_summary",
        """
        flight_date DATE, tail_number STRING, aircraft_name STRING, aircraft_code STRING,
        reporting_airline STRING, total_flights BIGINT, completed_flights BIGINT,
        cancelled_flights BIGINT, delayed_arrival_flights BIGINT,
        avg_departure_delay_minutes DECIMAL(9,2), avg_arrival_delay_minutes DECIMAL(9,2),
        max_arrival_delay_minutes INT, total_weather_delay_minutes BIGINT,
        total_carrier_delay_minutes BIGINT, total_late_aircraft_delay_minutes BIGINT,
        load_timestamp TIMESTAMP
        """,
        ("flight_date",),
    ),
    # ---- state: sums, counts and extremes behind the reports, which can be merged ----------
    TableDef(
        "state.route_months",
        """
        origin_airport STRING, dest_airport STRING, route_code STRING,
        first_seen_flight_date DATE, last_seen_flight_date DATE, total_record_count BIGINT,
        ingestion_timestamp TIMESTAMP, batch_id STRING, year_month STRING
        """,
        ("year_month",),
    ),
    TableDef(
        "state.on_time_daily",
        """
        flight_date DATE, reporting_airline STRING, total_flights BIGINT,
        completed_flights BIGINT, cancelled_flights BIGINT, diverted_flights BIGINT,
        delayed_departure_flights BIGINT, delayed_arrival_flights BIGINT,
        on_time_departure_flights BIGINT, on_time_arrival_flights BIGINT,
        sum_departure_delay_minutes BIGINT, known_departure_delay_minutes BIGINT,
        sum_arrival_delay_minutes BIGINT, known_arrival_delay_minutes BIGINT,
        total_weather_delay_minutes BIGINT, total_carrier_delay_minutes BIGINT,
        total_nas_delay_minutes BIGINT, total_security_delay_minutes BIGINT,
        total_late_aircraft_delay_minutes BIGINT
        """,
        ("flight_date",),
    ),
]

TABLES: dict[str, TableDef] = {d.name: d for d in _DEFS}


def rejected_name(target: str) -> str:
    """Name of the table that takes the rejected rows of ``target``."""
    return target.removesuffix("_raw") + "_rejected"
