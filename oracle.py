"""The registered queries as SQL for DuckDB, written independently of the Spark plans.

Every statement is built from the common table expressions below, which derive the raw feeds
from the star-schema tables.
"""

from __future__ import annotations


def _clock(x: str) -> str:
    return f"lpad(CAST(({x}) // 60 AS VARCHAR), 2, '0') || lpad(CAST(({x}) % 60 AS VARCHAR), 2, '0')"


def _cause(n: int) -> str:
    return (
        f"CAST(CASE WHEN NOT canc AND ad > 15 AND l_linenumber % 5 = {n} "
        "THEN ad + 5 * restated ELSE 0 END AS DOUBLE)"
    )


FEED = f"""
basis AS (
  SELECT *,
    (l_orderkey * 7 + l_linenumber * 131) % 1440 AS m,
    ((l_orderkey * 7 + l_linenumber * 131) % 1440 + 45 + l_suppkey % 400) % 1440 AS m2,
    CAST(trunc(l_quantity) AS INTEGER) AS q,
    CAST(trunc(l_quantity) AS INTEGER) - 12 AS dd,
    CAST(trunc(l_quantity) AS INTEGER) - 24 + l_partkey % 33 AS ad,
    (l_orderkey + l_linenumber) % 25 = 0 AS canc
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN (VALUES (0), (1)) report(restated) ON restated = 0 OR l_linenumber = 1
),
feed AS (
  SELECT
    CAST(l_shipdate AS DATE) AS flight_date,
    upper(substr(c_mktsegment, 1, 2)) AS reporting_airline,
    c_mktsegment AS reporting_airline_name,
    'N' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')
      || CASE WHEN l_partkey % 4 = 0 THEN 'B0'
         ELSE 'B' || lpad(replace(p_brand, 'Brand#', ''), 3, '0') END AS tail_number,
    CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_orderkey % 10000 AS VARCHAR) END AS flight_number,
    CASE WHEN l_suppkey % 53 = 0 THEN ''
      ELSE ' n' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS origin_airport,
    CAST(10000 + s_nationkey AS VARCHAR) AS origin_airport_seq_id,
    'City ' || s_nationkey AS origin_city_name,
    'S' || (s_nationkey % 10) AS origin_state_abbr,
    'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS dest_airport,
    CAST(20000 + c_nationkey AS VARCHAR) AS dest_airport_seq_id,
    'City ' || c_nationkey AS dest_city_name,
    'S' || (c_nationkey % 10) AS dest_state_abbr,
    CASE WHEN l_partkey % 89 = 0 THEN '2400' ELSE {_clock("m")} END AS crs_dep_time,
    CASE WHEN canc OR l_partkey % 71 = 0 THEN ''
      ELSE {_clock("(m + dd + 1440) % 1440")} END AS dep_time,
    CASE WHEN NOT canc THEN CAST(dd + 5 * restated AS DOUBLE) END AS dep_delay_minutes,
    CAST(l_partkey % 18 + 11 AS DOUBLE) AS taxi_out,
    CAST(l_partkey % 12 + 5 AS DOUBLE) AS taxi_in,
    CASE WHEN l_partkey % 83 = 0 THEN '9999' ELSE {_clock("m2")} END AS crs_arr_time,
    CASE WHEN canc OR l_partkey % 73 = 0 THEN ''
      ELSE {_clock("(m2 + ad + 1440) % 1440")} END AS arr_time,
    CASE WHEN NOT canc THEN CAST(ad + 5 * restated AS DOUBLE) END AS arr_delay_minutes,
    CASE WHEN l_partkey % 101 <> 0 THEN CAST(canc AS INTEGER) END AS cancelled,
    CASE WHEN canc THEN CASE l_suppkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
      WHEN 3 THEN 'D' END END AS cancellation_code,
    CAST(NOT canc AND l_partkey % 67 = 0 AS INTEGER) AS diverted,
    CAST(l_suppkey % 2500 + 100 AS DOUBLE) AS distance_miles,
    {_cause(0)} AS carrier_delay,
    {_cause(1)} AS weather_delay,
    {_cause(2)} AS nas_delay,
    {_cause(3)} AS security_delay,
    {_cause(4)} AS late_aircraft_delay,
    'line ' || l_orderkey || '/' || l_linenumber AS raw_record,
    'flights_' || strftime(l_shipdate, '%Y-%m') || '.csv' AS source_file_name,
    'star_feed' AS source_system,
    CAST(o_orderdate AS TIMESTAMP) + to_days(restated) AS ingestion_timestamp,
    'batch_' || year(o_orderdate) || CASE WHEN restated = 1 THEN '_r' ELSE '' END AS batch_id,
    sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, q,
      CAST(round(l_extendedprice * 100) AS BIGINT)))
      || CASE WHEN restated = 1 THEN '|r' ELSE '' END AS record_hash,
    strftime(l_shipdate, '%Y-%m') AS year_month
  FROM basis
)"""


def _digits(column: str) -> str:
    return f"regexp_replace({column}, '[^0-9]', '', 'g')"


def _parsed(column: str) -> str:
    padded = f"lpad({_digits(column)}, 4, '0')"
    return (
        f"CASE WHEN {_digits(column)} <> '' THEN try_strptime(strftime(flight_date, '%Y-%m-%d') "
        f"|| ' ' || substr({padded}, 1, 2) || ':' || substr({padded}, 3, 2), '%Y-%m-%d %H:%M') END"
    )


JUDGED = f"""
parsed AS (
  SELECT * REPLACE (upper(trim(origin_airport)) AS origin_airport,
                    upper(trim(dest_airport)) AS dest_airport,
                    trim(flight_number) AS flight_number),
    cancelled = 1 AS cancelled_flag,
    diverted = 1 AS diverted_flag,
    {_parsed("crs_dep_time")} AS sched_dep,
    {_parsed("crs_arr_time")} AS sched_arr,
    CASE WHEN cancelled = 1 THEN NULL ELSE {_parsed("dep_time")} END AS act_dep,
    CASE WHEN cancelled = 1 THEN NULL ELSE {_parsed("arr_time")} END AS act_arr
  FROM feed
),
rolled AS (
  SELECT *, concat_ws('-', origin_airport, dest_airport) AS route_code,
    sched_dep AS scheduled_departure_ts,
    CASE WHEN sched_arr < sched_dep THEN sched_arr + INTERVAL 1 DAY ELSE sched_arr END
      AS scheduled_arrival_ts,
    act_dep AS actual_departure_ts,
    CASE WHEN act_arr < act_dep THEN act_arr + INTERVAL 1 DAY ELSE act_arr END
      AS actual_arrival_ts
  FROM parsed
),
judged AS (
  SELECT *,
    CASE WHEN flight_number IS NULL OR flight_number = '' THEN 'MISSING_FLIGHT_NUMBER'
      WHEN origin_airport IS NULL OR dest_airport IS NULL OR origin_airport = ''
        OR dest_airport = '' THEN 'MISSING_AIRPORT_CODE'
      WHEN origin_airport = dest_airport THEN 'INVALID_ROUTE'
      WHEN sched_dep IS NULL THEN 'INVALID_SCHEDULED_DEPARTURE'
      WHEN sched_arr IS NULL THEN 'INVALID_SCHEDULED_ARRIVAL'
      WHEN NOT cancelled_flag AND act_dep IS NULL THEN 'MISSING_ACTUAL_DEPARTURE'
      WHEN NOT cancelled_flag AND act_arr IS NULL THEN 'MISSING_ACTUAL_ARRIVAL'
    END AS quality_issue_reason
  FROM rolled
  QUALIFY row_number() OVER (
    PARTITION BY flight_date, reporting_airline, flight_number, origin_airport, dest_airport
    ORDER BY ingestion_timestamp DESC NULLS LAST, record_hash DESC NULLS LAST,
      batch_id DESC NULLS LAST, source_file_name DESC NULLS LAST) = 1
)"""

_MINUTES = {
    "departure_delay_minutes": "dep_delay_minutes",
    "arrival_delay_minutes": "arr_delay_minutes",
    "taxi_out_minutes": "taxi_out",
    "taxi_in_minutes": "taxi_in",
    "carrier_delay_minutes": "carrier_delay",
    "weather_delay_minutes": "weather_delay",
    "nas_delay_minutes": "nas_delay",
    "security_delay_minutes": "security_delay",
    "late_aircraft_delay_minutes": "late_aircraft_delay",
}

CLEAN = (
    """
flights AS (
  SELECT flight_date, reporting_airline, reporting_airline_name, tail_number, flight_number,
    origin_airport, dest_airport, route_code, origin_city_name, origin_state_abbr,
    dest_city_name, dest_state_abbr, scheduled_departure_ts, actual_departure_ts,
    scheduled_arrival_ts, actual_arrival_ts, """
    + ", ".join(f"CAST(trunc({old}) AS INTEGER) AS {new}" for new, old in _MINUTES.items())
    + """,
    cancelled_flag, cancellation_code, diverted_flag, distance_miles,
    coalesce(arr_delay_minutes, 0) > 15 AS is_delayed_flag,
    NOT cancelled_flag AND coalesce(arr_delay_minutes, 0) <= 15 AS is_on_time_arrival_flag,
    NOT cancelled_flag AND coalesce(dep_delay_minutes, 0) <= 15 AS is_on_time_departure_flag,
    'VALID' AS processing_status, quality_issue_reason, ingestion_timestamp, batch_id,
    source_file_name, record_hash, year_month
  FROM judged WHERE quality_issue_reason IS NULL
)"""
)

AIRPORTS = """
airport_feed AS (
  SELECT c_custkey, c_name, c_nationkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS nn,
    CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS ingested,
    'batch_' || (c_custkey % 7) AS batch_id,
    sha256(concat_ws('|', c_custkey, c_name)) AS record_hash
  FROM customer WHERE c_nationkey <> 24 AND c_custkey % 29 <> 0
),
airports AS (
  SELECT 'N' || nn AS airport_iata_code, 'KN' || nn AS airport_icao_code,
    'KN' || nn AS airport_ident, c_name AS airport_name,
    CASE WHEN c_custkey % 3 = 0 THEN 'large_airport' ELSE 'medium_airport' END AS airport_type,
    'City ' || c_nationkey AS municipality, 'C' || c_nationkey AS iso_country,
    'R-' || c_nationkey AS iso_region, 'NA' AS continent,
    CAST(c_nationkey * 3 - 36 AS DOUBLE) AS latitude_deg,
    CAST(c_nationkey * 7 - 84 AS DOUBLE) AS longitude_deg,
    CAST(c_custkey % 900 AS DOUBLE) AS elevation_ft,
    c_custkey % 4 IN (0, 1) AS scheduled_service_flag,
    ingested AS ingestion_timestamp, batch_id
  FROM airport_feed
  QUALIFY row_number() OVER (PARTITION BY c_nationkey
    ORDER BY ingested DESC, record_hash DESC, batch_id DESC) = 1
)"""

AIRCRAFT = """
aircraft AS (
  SELECT 'B' || code AS aircraft_code, p_brand AS aircraft_name, 'T' || code AS iata_code,
    'B' || code AS icao_code, ingested AS ingestion_timestamp, batch_id
  FROM (
    SELECT p_brand, lpad(replace(p_brand, 'Brand#', ''), 3, '0') AS code,
      CAST(DATE '2020-01-01' + CAST(p_partkey % 365 AS INTEGER) AS TIMESTAMP) AS ingested,
      'batch_' || (p_partkey % 7) AS batch_id,
      sha256(concat_ws('|', p_partkey, p_name)) AS record_hash
    FROM part WHERE p_partkey % 31 <> 0
  )
  QUALIFY row_number() OVER (PARTITION BY code
    ORDER BY ingested DESC, record_hash DESC, batch_id DESC) = 1
)"""

WEATHER = """
weather AS (
  SELECT 'KN' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS station_id,
    date_trunc('hour', ts) AS observation_time, CAST(ts AS DATE) AS observation_date,
    CAST(cents % 40 AS DOUBLE) AS temp_c, CAST(cents % 20 AS DOUBLE) AS dewpoint_c,
    CAST(cents % 36 * 10 AS INTEGER) AS wind_dir_degrees,
    CAST(cents % 45 AS DOUBLE) AS wind_speed_kt, CAST(cents % 60 AS DOUBLE) AS wind_gust_kt,
    CAST(cents % 10 + 1 AS DOUBLE) AS visibility_statute_mi,
    CAST(cents % 100 + 2920 AS DOUBLE) / 100 AS altim_in_hg,
    ['VFR', 'MVFR', 'IFR', 'LIFR'][CAST(event_id % 4 AS INTEGER) + 1] AS flight_category,
    CAST(cents % 15 AS DOUBLE) / 100 AS precip_in,
    ['CLR', 'FEW', 'SCT', 'BKN', 'OVC'][CAST(event_id % 5 AS INTEGER) + 1] AS sky_cover,
    ts AS ingestion_timestamp, 'batch_' || event_type AS batch_id
  FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
  WHERE user_id % 41 <> 0
  QUALIFY row_number() OVER (PARTITION BY user_id % 25, date_trunc('hour', ts)
    ORDER BY ts DESC, sha256(concat_ws('|', event_id, user_id, event_type)) DESC) = 1
)"""

# Observation 35 minutes ahead of every scheduled movement of the raw feed.
AHEAD = f"""
movements AS (
  SELECT upper(trim(origin_airport)) AS airport, {_parsed("crs_dep_time")} AS moment,
    coalesce(weather_delay > 0 OR cancellation_code = 'B', FALSE) AS bad FROM feed
  UNION ALL
  SELECT upper(trim(dest_airport)), {_parsed("crs_arr_time")},
    coalesce(weather_delay > 0 OR cancellation_code = 'B', FALSE) FROM feed
),
ahead AS (
  SELECT 'K' || airport AS station_id, moment - INTERVAL 35 MINUTE AS observation_time,
    CAST(moment - INTERVAL 35 MINUTE AS DATE) AS observation_date,
    CASE WHEN bool_or(bad) THEN 'IFR' ELSE 'VFR' END AS flight_category,
    CASE WHEN bool_or(bad) THEN 18.0 ELSE 5.0 END::DOUBLE AS wind_speed_kt,
    CASE WHEN bool_or(bad) THEN 1.4 ELSE 10.0 END::DOUBLE AS visibility_statute_mi
  FROM movements WHERE airport <> '' AND moment IS NOT NULL
  GROUP BY airport, moment
)"""

# Raw JSON lines derived from the events: some values do not fit, some lines are cut off.
LINES = """
lines AS (
  SELECT event_id, CASE
    WHEN event_id % 23 = 0 THEN '{"event_id":' || event_id || ',"value":'
    ELSE '{"event_id":' || event_id || ',"value":'
      || CASE WHEN event_id % 17 = 0 THEN '"n/a"' WHEN event_id % 19 = 0 THEN '""'
         WHEN event_id % 31 = 0 THEN '"9007199254740993.0"'
         ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
           || CASE WHEN event_id % 13 = 0 THEN '.5' WHEN event_id % 11 = 0 THEN '.0' ELSE '' END END
      || ',"kind":"' || event_type || '"'
      || CASE WHEN event_id % 29 = 0 THEN ',"extra":"' || user_id || '"' ELSE '' END || '}'
    END AS line
  FROM events
),
delivered AS (
  SELECT event_id, line, json_valid(line) AS ok, regexp_extract(line, '"value":"?([^",}]*)', 1) AS v FROM lines
)"""
# What a whole-number field accepts.
_WHOLE = "regexp_matches(v, '^-?[0-9]+([.]0*)?$')"

_COUNTS = """count(*) AS total_flights,
  count(*) FILTER (NOT cancelled_flag) AS completed_flights,
  count(*) FILTER (cancelled_flag) AS cancelled_flights"""
_AVERAGES = """avg(departure_delay_minutes) AS avg_departure_delay_minutes,
  avg(arrival_delay_minutes) AS avg_arrival_delay_minutes"""


def _totals(*causes: str) -> str:
    return ",\n  ".join(
        f"CAST(sum(coalesce({c}_delay_minutes, 0)) AS BIGINT) AS total_{c}_delay_minutes"
        for c in causes
    )


_LATE_ARRIVALS = "count(*) FILTER (coalesce(arrival_delay_minutes, 0) > 15) AS delayed_arrival_flights"
_PROFILE = f"""{_COUNTS}, {_LATE_ARRIVALS}, {_AVERAGES},
  max(arrival_delay_minutes) AS max_arrival_delay_minutes,
  {_totals("weather", "carrier", "late_aircraft")}"""

OTP = f"""
otp AS (
  SELECT flight_date, reporting_airline, {_COUNTS},
    count(*) FILTER (diverted_flag) AS diverted_flights,
    count(*) FILTER (coalesce(departure_delay_minutes, 0) > 15) AS delayed_departure_flights,
    {_LATE_ARRIVALS},
    count(*) FILTER (is_on_time_departure_flag) AS on_time_departure_flights,
    count(*) FILTER (is_on_time_arrival_flag) AS on_time_arrival_flights,
    CASE WHEN count(*) FILTER (NOT cancelled_flag) > 0
      THEN count(*) FILTER (is_on_time_arrival_flag) * 100.0::DOUBLE
        / count(*) FILTER (NOT cancelled_flag) ELSE 0 END AS on_time_arrival_percentage,
    {_AVERAGES}, {_totals("weather", "carrier", "nas", "security", "late_aircraft")}
  FROM flights GROUP BY flight_date, reporting_airline
)"""
ROUTES = f"""
route_delays AS (
  SELECT flight_date, route_code, origin_airport, dest_airport, reporting_airline, {_PROFILE}
  FROM flights GROUP BY ALL
)"""
AIRPORT_DELAYS = f"""
visits AS (
  SELECT flight_date, origin_airport AS airport_code, 'DEPARTURE' AS airport_role,
    reporting_airline, cancelled_flag, is_on_time_departure_flag AS on_time,
    coalesce(departure_delay_minutes, 0) AS delay, weather_delay_minutes,
    carrier_delay_minutes, late_aircraft_delay_minutes FROM flights
  UNION ALL
  SELECT flight_date, dest_airport, 'ARRIVAL', reporting_airline, cancelled_flag,
    is_on_time_arrival_flag, coalesce(arrival_delay_minutes, 0), weather_delay_minutes,
    carrier_delay_minutes, late_aircraft_delay_minutes FROM flights
),
airport_delays AS (
  SELECT flight_date, airport_code, airport_role, reporting_airline, {_COUNTS},
    count(*) FILTER (delay > 15) AS delayed_flights,
    count(*) FILTER (on_time) AS on_time_flights,
    avg(delay) AS avg_delay_minutes, max(delay) AS max_delay_minutes,
    {_totals("weather", "carrier", "late_aircraft")}
  FROM visits GROUP BY flight_date, airport_code, airport_role, reporting_airline
)"""
CANCELLED = """
cancelled AS (
  SELECT flight_date, reporting_airline, origin_airport, dest_airport, cancellation_code,
    CASE cancellation_code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
      WHEN 'C' THEN 'National Air System' WHEN 'D' THEN 'Security' ELSE 'Unknown' END
      AS cancellation_reason,
    count(*) AS cancellation_count
  FROM flights WHERE cancelled_flag GROUP BY ALL
)"""
PERFORMANCE = f"""
performance AS (
  SELECT flight_date, tail_number, aircraft_name, code AS aircraft_code, reporting_airline,
    {_PROFILE}
  FROM (SELECT *, upper(regexp_extract(tail_number, '([A-Z0-9]{{2,4}})$', 1)) AS code FROM flights)
  LEFT JOIN (SELECT aircraft_code, aircraft_name FROM aircraft) a ON code = a.aircraft_code
  GROUP BY flight_date, tail_number, aircraft_name, code, reporting_airline
)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


_FLIGHTS = (FEED, JUDGED, CLEAN)


def _counts(tables: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in tables.items()
    )


def _one_column(name: str, value: str, source: str) -> str:
    return f"(SELECT CAST({value} AS BIGINT) FROM {source}) AS {name}"


ORACLE: dict[str, str] = {
    # sources and derived feeds
    "raw_flights": _with(FEED, select="SELECT * FROM feed"),
    "movement_weather": _with(FEED, AHEAD, select="SELECT * FROM ahead"),
    # reporting tables
    "otp_daily": _with(*_FLIGHTS, OTP, select="SELECT * FROM otp"),
    "route_delay": _with(*_FLIGHTS, ROUTES, select="SELECT * FROM route_delays"),
    "airport_delay": _with(*_FLIGHTS, AIRPORT_DELAYS, select="SELECT * FROM airport_delays"),
    "cancellations": _with(*_FLIGHTS, CANCELLED, select="SELECT * FROM cancelled"),
    "aircraft_perf": _with(
        *_FLIGHTS, AIRCRAFT, PERFORMANCE, select="SELECT * FROM performance"
    ),
    # cleaned tables
    "flights_clean": _with(*_FLIGHTS, select="SELECT * FROM flights"),
    "flights_quarantine": _with(
        FEED,
        JUDGED,
        select="""
SELECT CAST(flight_date AS VARCHAR) AS raw_flight_date, reporting_airline, flight_number,
  origin_airport, dest_airport, quality_issue_reason, raw_record, source_file_name,
  ingestion_timestamp, batch_id, record_hash
FROM judged WHERE quality_issue_reason IS NOT NULL""",
    ),
    "quality_reason_counts": _with(
        FEED,
        JUDGED,
        select="""
SELECT coalesce(quality_issue_reason, 'VALID') AS verdict, count(*) AS flights
FROM judged GROUP BY quality_issue_reason""",
    ),
    "route_reference": _with(
        *_FLIGHTS,
        select="""
SELECT origin_airport, dest_airport, route_code,
  origin_airport || '_' || dest_airport AS route_group,
  min(flight_date) AS first_seen_flight_date, max(flight_date) AS last_seen_flight_date,
  count(*) AS total_record_count, max(ingestion_timestamp) AS ingestion_timestamp,
  max(batch_id) AS batch_id
FROM flights GROUP BY origin_airport, dest_airport, route_code""",
    ),
    "airports_clean": _with(AIRPORTS, select="SELECT * FROM airports"),
    "aircraft_clean": _with(AIRCRAFT, select="SELECT * FROM aircraft"),
    "weather_clean": _with(WEATHER, select="SELECT * FROM weather"),
    # single operators
    "hhmm_parse": _with(
        FEED,
        select=f"""
SELECT record_hash, batch_id, crs_dep_time, {_parsed("crs_dep_time")} AS scheduled_departure_ts,
  dep_time, {_parsed("dep_time")} AS actual_departure_ts FROM feed""",
    ),
    "overnight_roll": _with(
        FEED,
        JUDGED,
        select="""
SELECT record_hash, batch_id, scheduled_departure_ts, scheduled_arrival_ts,
  actual_departure_ts, actual_arrival_ts FROM rolled""",
    ),
    "latest_record_dedupe": _with(
        FEED,
        select="""
SELECT * FROM feed
QUALIFY row_number() OVER (
  PARTITION BY flight_date, reporting_airline, flight_number, origin_airport, dest_airport
  ORDER BY ingestion_timestamp DESC, record_hash DESC, batch_id DESC, source_file_name DESC) = 1""",
    ),
    "rescue_clean": _with(
        LINES,
        select=f"""
SELECT event_id, CAST(nullif(split_part(v, '.', 1), '') AS BIGINT) AS value,
  json_extract_string(line, '$.kind') AS kind
FROM delivered WHERE ok AND (v = '' OR {_WHOLE}) AND json_extract(line, '$.extra') IS NULL""",
    ),
    "rescue_rejected": _with(
        LINES,
        select=f"""
SELECT 'bronze.event_lines_raw' AS source_table, 'star_events' AS source_system,
  'events.jsonl' AS source_file_name, 'batch_1' AS batch_id,
  CASE WHEN NOT ok THEN '{{"_corrupt_record":"' || replace(line, '"', '\\"') || '"}}'
    ELSE '{{' || concat_ws(',', CASE WHEN misfit THEN '"value":"' || v || '"' END,
      CASE WHEN stranger IS NOT NULL THEN '"extra":"' || stranger || '"' END) || '}}' END
    AS rescued_data,
  CASE WHEN ok THEN '{{"event_id":"' || event_id || '"'
    || CASE WHEN v <> '' THEN ',"value":"' || v || '"' ELSE '' END
    || ',"kind":"' || json_extract_string(line, '$.kind') || '"}}' ELSE '{{}}' END AS raw_payload
FROM (
  SELECT *, v <> '' AND NOT {_WHOLE} AS misfit,
    CASE WHEN ok THEN json_extract_string(line, '$.extra') END AS stranger
  FROM delivered
)
WHERE NOT ok OR misfit OR stranger IS NOT NULL""",
    ),
    "metadata_fill": """
SELECT event_id,
  CASE WHEN event_id % 3 = 0 THEN 'feed_' || event_type || '.csv' ELSE 'events.parquet' END
    AS source_file_name,
  CASE WHEN event_id % 5 = 0 THEN 'sys_' || event_type ELSE 'star_events' END AS source_system,
  CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '2030-01-01' ELSE date_trunc('second', ts) END
    AS ingestion_timestamp,
  'batch_9' AS batch_id
FROM events""",
    "metadata_overwrite": """
SELECT event_id, 'events.parquet' AS source_file_name, 'star_events' AS source_system,
  TIMESTAMP '2030-01-01' AS ingestion_timestamp, 'batch_9' AS batch_id
FROM events""",
    "align_schema": """
SELECT CAST(p_partkey AS VARCHAR) AS aircraft_code, p_name AS aircraft_name,
  TRY_CAST(p_brand AS INTEGER) AS iata_code, p_size AS icao_code,
  CAST(NULL AS VARCHAR) AS raw_record FROM part""",
    "schema_evolution": """
SELECT o_orderkey AS k, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS priority
FROM orders WHERE year(o_orderdate) < 1998
UNION ALL
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1998""",
    "batch_replace": _with(
        FEED,
        select="""
, incoming AS (
  SELECT nullif(left(batch_id, 10), 'batch_1996') AS batch_id, record_hash, arr_delay_minutes
  FROM feed WHERE batch_id IN ('batch_1995_r', 'batch_1996_r', 'batch_1997_r')
),
existing AS (
  SELECT nullif(batch_id, 'batch_1998') AS batch_id, record_hash, arr_delay_minutes FROM feed
  WHERE length(batch_id) = 10
)
SELECT * FROM existing e WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.batch_id = e.batch_id)
UNION ALL
SELECT * FROM incoming""",
    ),
    "row_fingerprint": """
SELECT p_partkey, payload AS raw_record,
  sha256('{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_partkey":' || p_partkey
    || ',"p_size":' || p_size || ',"raw_record":"' || replace(payload, '"', '\\"') || '"}')
    AS record_hash
FROM (SELECT *, '{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_partkey":'
  || p_partkey || ',"p_size":' || p_size || '}' AS payload FROM part)""",
    # validation
    "missing_identifiers": _with(
        FEED,
        select="""
SELECT count(*) FILTER (flight_number IS NULL OR trim(flight_number) = '') AS missing_flight_number,
  count(*) FILTER (origin_airport IS NULL OR trim(origin_airport) = '') AS missing_origin,
  count(*) FILTER (dest_airport IS NULL OR trim(dest_airport) = '') AS missing_dest
FROM feed""",
    ),
    "duplicate_keys": _with(
        FEED,
        select="""
SELECT flight_date, reporting_airline, flight_number, origin_airport, dest_airport,
  count(*) AS duplicate_count
FROM feed GROUP BY ALL HAVING count(*) > 1 ORDER BY duplicate_count DESC""",
    ),
    "bronze_counts": _with(
        FEED,
        select=_counts(
            {
                "flight_operations_raw": "feed",
                "airports_raw": "customer",
                "aircraft_reference_raw": "part",
                "weather_metar_raw": "events",
            }
        ),
    ),
    "silver_counts": _with(
        *_FLIGHTS,
        AIRPORTS,
        AIRCRAFT,
        WEATHER,
        select=_counts(
            {
                "flight_operations_clean": "flights",
                "flight_operations_quarantine": "judged WHERE quality_issue_reason IS NOT NULL",
                "airports_clean": "airports",
                "aircraft_reference_clean": "aircraft",
                "route_reference": "(SELECT DISTINCT route_code FROM flights)",
                "weather_observations_clean": "weather",
            }
        ),
    ),
    "gold_counts": _with(
        *_FLIGHTS,
        AIRCRAFT,
        OTP,
        ROUTES,
        AIRPORT_DELAYS,
        CANCELLED,
        PERFORMANCE,
        select=_counts(
            {
                "on_time_performance_daily": "otp",
                "route_delay_summary": "route_delays",
                "airport_delay_summary": "airport_delays",
                "cancellation_summary": "cancelled",
                "aircraft_performance_summary": "performance",
            }
        ),
    ),
    "rejected_counts": _with(
        LINES,
        select="""
SELECT 'event_lines_rejected' AS "check", 'bronze' AS layer, count(*) AS observed,
  CAST(0 AS BIGINT) AS expected, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'CHECK' END AS status
FROM lines WHERE event_id % 23 = 0 OR event_id % 17 = 0 OR event_id % 29 = 0
  OR (event_id % 13 = 0 AND event_id % 19 <> 0 AND event_id % 31 <> 0)""",
    ),
    "expected_volumes": _with(
        FEED,
        select="""
SELECT 'rows of ' || t AS "check", 'bronze' AS layer, n AS observed, want AS expected,
  CASE WHEN want IS NULL THEN 'INFO' WHEN n = want THEN 'PASS' ELSE 'CHECK' END AS status
FROM (
  SELECT 'flight_operations_raw' AS t, count(*) AS n, CAST(720 AS BIGINT) AS want FROM feed
  UNION ALL SELECT 'airports_raw', count(*), 8 FROM customer
  UNION ALL SELECT 'aircraft_reference_raw', count(*), 4 FROM part
  UNION ALL SELECT 'weather_metar_raw', count(*), NULL FROM events
)""",
    ),
    "timestamp_sanity": _with(
        *_FLIGHTS,
        select="""
SELECT count(*) FILTER (scheduled_arrival_ts < scheduled_departure_ts) AS invalid_scheduled_sequence,
  count(*) FILTER (actual_arrival_ts < actual_departure_ts) AS invalid_actual_sequence,
  count(*) FILTER (route_code <> origin_airport || '-' || dest_airport) AS invalid_route_code
FROM flights""",
    ),
    "timestamp_sanity_unrolled": _with(
        FEED,
        JUDGED,
        select="""
SELECT count(*) FILTER (sched_arr < sched_dep) AS invalid_scheduled_sequence,
  count(*) FILTER (act_arr < act_dep) AS invalid_actual_sequence,
  count(*) FILTER (route_code <> origin_airport || '-' || dest_airport) AS invalid_route_code
FROM rolled""",
    ),
    "airport_coverage": _with(
        *_FLIGHTS,
        AIRPORTS,
        select="""
SELECT
  (SELECT count(*) FROM flights f LEFT JOIN airports a ON f.origin_airport = a.airport_iata_code
   WHERE a.airport_iata_code IS NULL) AS unmatched_origin_airports,
  (SELECT count(*) FROM flights f LEFT JOIN airports a ON f.dest_airport = a.airport_iata_code
   WHERE a.airport_iata_code IS NULL) AS unmatched_dest_airports""",
    ),
    "percentage_range": _with(
        *_FLIGHTS,
        OTP,
        select="""
SELECT count(*) AS invalid_on_time_percentage FROM otp
WHERE on_time_arrival_percentage < 0 OR on_time_arrival_percentage > 100""",
    ),
    "cancellation_code_check": _with(
        *_FLIGHTS,
        select="""
SELECT count(*) FILTER (cancelled_flag
    AND (cancellation_code IS NULL OR cancellation_code NOT IN ('A', 'B', 'C', 'D')))
    AS cancelled_without_reason,
  count(*) FILTER (NOT cancelled_flag AND cancellation_code IS NOT NULL)
    AS reason_without_cancellation
FROM flights""",
    ),
    "processed_totals": _with(
        FEED,
        JUDGED,
        select="""
SELECT count(*) FILTER (quality_issue_reason IS NULL) AS clean_count,
  count(*) FILTER (quality_issue_reason IS NOT NULL) AS quarantine_count,
  count(*) AS total_processed_count FROM judged""",
    ),
    "reconcile_cancellations": _with(
        *_FLIGHTS,
        CANCELLED,
        select="SELECT "
        + _one_column("gold_cancellations", "coalesce(sum(cancellation_count), 0)", "cancelled")
        + ", "
        + _one_column("silver_cancelled_flights", "count(*) FILTER (cancelled_flag)", "flights"),
    ),
    "reconcile_routes": _with(
        *_FLIGHTS,
        ROUTES,
        select="SELECT "
        + _one_column("gold_route_rows", "count(*)", "route_delays")
        + ", "
        + _one_column(
            "expected_route_rows",
            "count(*)",
            "(SELECT DISTINCT flight_date, route_code, origin_airport, dest_airport, "
            "reporting_airline FROM flights)",
        ),
    ),
    "reconcile_airports": _with(
        *_FLIGHTS,
        AIRPORT_DELAYS,
        select="SELECT "
        + _one_column("gold_airport_rows", "count(*)", "airport_delays")
        + ", "
        + _one_column(
            "expected_airport_rows",
            "count(*)",
            "(SELECT flight_date, origin_airport, reporting_airline FROM flights GROUP BY ALL "
            "UNION ALL SELECT flight_date, dest_airport, reporting_airline FROM flights GROUP BY ALL)",
        ),
    ),
    "otp_sample_top20": _with(
        *_FLIGHTS,
        OTP,
        select="SELECT * FROM otp ORDER BY flight_date, reporting_airline LIMIT 20",
    ),
    # table search over a listing derived from the parts
    "table_search": """
SELECT catalog, schema, "table", 'MANAGED' AS table_type FROM (
  SELECT DISTINCT p_type AS catalog, p_brand AS schema, replace(p_name, ' ', '_') AS "table"
  FROM part WHERE contains(p_name, 'widget') AND p_type <> 'SMALL')
ORDER BY "table" NOT LIKE 'widget%', catalog, schema, "table" LIMIT 20""",
    "table_search_secondary": """
SELECT catalog, schema, "table", 'MANAGED' AS table_type FROM (
  SELECT DISTINCT p_type AS catalog, p_brand AS schema, replace(p_name, ' ', '_') AS "table",
    p_type = 'SMALL' AS secondary
  FROM part WHERE lower(p_name) = 'red widget')
ORDER BY secondary, catalog, schema, "table" LIMIT 1000""",
    "table_best_match": """
SELECT concat_ws('.', p_type, p_brand, replace(p_name, ' ', '_')) AS full_path FROM part
WHERE contains(p_name, 'bolt') AND p_type <> 'SMALL'
ORDER BY p_type, p_brand, p_name LIMIT 1""",
    # weather at the movement
    "weather_asof": _with(
        *_FLIGHTS,
        AIRPORTS,
        AHEAD,
        select="""
SELECT f.record_hash, f.batch_id, f.origin_airport, f.scheduled_departure_ts, a.station_id,
  CASE WHEN young THEN o.observation_time END AS observation_time,
  CASE WHEN young THEN o.flight_category END AS flight_category,
  CASE WHEN young THEN o.wind_speed_kt END AS wind_speed_kt,
  CASE WHEN young THEN o.visibility_statute_mi END AS visibility_statute_mi
FROM flights f
LEFT JOIN (SELECT airport_iata_code, airport_icao_code AS station_id FROM airports) a
  ON f.origin_airport = a.airport_iata_code
ASOF LEFT JOIN (SELECT *, TRUE AS known FROM ahead) o
  ON a.station_id = o.station_id AND f.scheduled_departure_ts >= o.observation_time,
LATERAL (SELECT coalesce(f.scheduled_departure_ts - o.observation_time <= INTERVAL 120 MINUTE,
  FALSE) AS young)""",
    ),
    "weather_asof_arrivals": _with(
        *_FLIGHTS,
        AIRPORTS,
        AHEAD,
        select="""
SELECT f.record_hash, f.batch_id, f.dest_airport, f.scheduled_arrival_ts, a.station_id,
  CASE WHEN young THEN o.observation_time END AS observation_time,
  CASE WHEN young THEN o.flight_category END AS flight_category,
  CASE WHEN young THEN o.wind_speed_kt END AS wind_speed_kt,
  CASE WHEN young THEN o.visibility_statute_mi END AS visibility_statute_mi
FROM flights f
LEFT JOIN (SELECT airport_iata_code, airport_icao_code AS station_id FROM airports) a
  ON f.dest_airport = a.airport_iata_code
ASOF LEFT JOIN ahead o
  ON a.station_id = o.station_id AND f.scheduled_arrival_ts >= o.observation_time,
LATERAL (SELECT coalesce(f.scheduled_arrival_ts - o.observation_time <= INTERVAL 60 MINUTE,
  FALSE) AS young)""",
    ),
}

# ---- single batches, merged states, gates: the same rows as from one pass ------------------

_MERGED = {
    "flights_restated": "flights_clean",
    "otp_merged": "otp_daily",
    "route_delay_merged": "route_delay",
    "airport_delay_merged": "airport_delay",
    "cancellations_merged": "cancellations",
    "aircraft_perf_merged": "aircraft_perf",
    "route_reference_merged": "route_reference",
}
ORACLE |= {name: ORACLE[same] for name, same in _MERGED.items()}

_EARLIER = JUDGED.replace("FROM feed", "FROM feed WHERE batch_id <> 'batch_1995_r'")
for _name in ("parsed", "rolled", "judged"):
    _EARLIER = _EARLIER.replace(f"{_name} AS (", f"earlier_{_name} AS (").replace(f"FROM {_name}\n", f"FROM earlier_{_name}\n")

_KEY = "flight_date, reporting_airline, flight_number, origin_airport, dest_airport, record_hash, batch_id"
_LAYERED = """SELECT "check", '{layer}' AS layer, observed, expected,
  CASE WHEN expected IS NULL THEN 'INFO' WHEN observed = expected THEN 'PASS' ELSE 'CHECK' END AS status
FROM ({rows})"""


def _gate(layer: str, *rows: tuple[str, str, str, str]) -> str:
    each = [
        f"SELECT '{name}' AS \"check\", CAST({seen} AS BIGINT) AS observed, CAST({want} AS BIGINT) AS expected FROM {source}"
        for name, seen, want, source in rows
    ]
    return _LAYERED.format(layer=layer, rows="\nUNION ALL\n".join(each))


ORACLE |= {
    "flights_retracted": _with(
        FEED,
        JUDGED,
        _EARLIER,
        select=f"""
SELECT {_KEY} FROM earlier_judged WHERE quality_issue_reason IS NULL
EXCEPT
SELECT {_KEY} FROM judged WHERE quality_issue_reason IS NULL""",
    ),
    "otp_monthly": _with(
        *_FLIGHTS,
        OTP.replace("otp AS (\n  SELECT flight_date,", "otp AS (\n  SELECT year_month,").replace(
            "GROUP BY flight_date,", "GROUP BY year_month,"
        ),
        select="SELECT * FROM otp",
    ),
    "silver_gate": _with(
        *_FLIGHTS,
        select=_gate(
            "silver",
            ("flights_clean_or_quarantined", "count(*)", "count(*)", "judged"),
            ("invalid_scheduled_sequence", "count(*) FILTER (scheduled_arrival_ts < scheduled_departure_ts)", "0", "flights"),
            ("invalid_actual_sequence", "count(*) FILTER (actual_arrival_ts < actual_departure_ts)", "0", "flights"),
            ("invalid_route_code", "count(*) FILTER (route_code <> origin_airport || '-' || dest_airport)", "0", "flights"),
            (
                "cancelled_without_reason",
                "count(*) FILTER (cancelled_flag AND coalesce(cancellation_code NOT IN ('A', 'B', 'C', 'D'), true))",
                "NULL",
                "flights",
            ),
            ("reason_without_cancellation", "count(*) FILTER (NOT cancelled_flag AND cancellation_code IS NOT NULL)", "NULL", "flights"),
        ),
    ),
    "gold_gate": _with(
        *_FLIGHTS,
        select=_gate(
            "gold",
            ("invalid_on_time_percentage", "0", "0", "(SELECT 1)"),
            ("flights in on_time_performance_daily", "count(*)", "count(*)", "flights"),
            ("flights in airport_delay_summary", "2 * count(*)", "2 * count(*)", "flights"),
            ("flights in cancellation_summary", "count(*) FILTER (cancelled_flag)", "count(*) FILTER (cancelled_flag)", "flights"),
        ),
    ),
    "known_airports_reasons": _with(
        FEED,
        JUDGED,
        AIRPORTS,
        select="""
SELECT coalesce(quality_issue_reason, CASE WHEN origin_airport NOT IN (SELECT airport_iata_code FROM airports
      WHERE airport_iata_code IS NOT NULL)
    OR dest_airport NOT IN (SELECT airport_iata_code FROM airports WHERE airport_iata_code IS NOT NULL)
    THEN 'UNKNOWN_AIRPORT' END, 'VALID') AS verdict, dest_airport, count(*) AS flights
FROM judged GROUP BY ALL""",
    ),
}

# ---- checks that find something, strict casts ----------------------------------------------

ORACLE |= {
    "percentage_range_violated": _with(
        *_FLIGHTS,
        OTP,
        select="""
SELECT count(*) AS invalid_on_time_percentage FROM otp
WHERE on_time_arrival_percentage * 2 - 50 NOT BETWEEN 0 AND 100""",
    ),
    "cancellation_codes_swapped": _with(
        *_FLIGHTS,
        select="""
SELECT count(*) FILTER (NOT cancelled_flag
    AND (cancellation_code IS NULL OR cancellation_code NOT IN ('A', 'B', 'C', 'D')))
    AS cancelled_without_reason,
  count(*) FILTER (cancelled_flag AND cancellation_code IS NOT NULL)
    AS reason_without_cancellation
FROM flights""",
    ),
    "expected_volumes_met": """
SELECT 'rows of region' AS "check", 'bronze' AS layer, count(*) AS observed, CAST(5 AS BIGINT) AS expected,
  CASE WHEN count(*) = 5 THEN 'PASS' ELSE 'CHECK' END AS status FROM region
UNION ALL SELECT 'rows of nation', 'bronze', count(*), 25,
  CASE WHEN count(*) = 25 THEN 'PASS' ELSE 'CHECK' END FROM nation
UNION ALL SELECT 'rows of orders', 'bronze', count(*), NULL, 'INFO' FROM orders""",
    "align_schema_strict": """
SELECT CAST(p_partkey AS INTEGER) AS part, CAST(p_retailprice AS DECIMAL(12, 2)) AS price,
  p_name AS name, CAST(NULL AS DATE) AS since FROM part""",
}
