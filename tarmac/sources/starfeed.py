"""Raw feeds derived from the star-schema tables.

Every line item becomes a flight, every customer row an airport report, every part an aircraft
report and every event a weather observation. Only integer arithmetic and text building is
used, so another SQL engine can derive the same rows. A share of rows is broken on purpose:
missing codes, impossible clocks, absent actual times, restatements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.clock import clock_number, number_timestamp
from tarmac.functions.codes import station_code

# Minutes between a weather observation and the movement it belongs to.
OBSERVATION_LEAD_MINUTES = 35


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _clock(minutes: str) -> str:
    """Hour and minute of a day, each padded to two digits; of one number where there is no sign."""
    hour, minute = f"({minutes}) div 60", f"({minutes}) % 60"
    apart = f"concat(lpad({hour}, 2, '0'), lpad({minute}, 2, '0'))"
    return f"if(({minutes}) >= 0, lpad({hour} * 100 + {minute}, 4, '0'), {apart})"


# cast(round(l_extendedprice * 100) as bigint), halves away from zero, without a detour by way of decimal text.
_CENTS = (
    "cast(l_extendedprice * 100 as bigint)"
    " + cast(l_extendedprice * 100 - cast(l_extendedprice * 100 as bigint) >= 0.5D as int)"
    " - cast(l_extendedprice * 100 - cast(l_extendedprice * 100 as bigint) <= -0.5D as int)"
)


def flight_basis(spark: SparkSession, folder: str, alike: Sequence[str] = ()) -> DataFrame:
    """What a flight report is computed from, a row per report; a fraction of its width.

    Orders meet their customers first, so that line items are exchanged for their order and, where parts are
    many, for their part only. Where a query reads the basis in several ways, ``alike`` names the columns of the tables that
    the widest of them needs: each then needs them all, by a condition that holds for every row, and Spark exchanges line items and
    orders once and reuses that instead of exchanging them again with fewer columns.
    """
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "cast(l_quantity as int) as q",
        "l_extendedprice",
        "cast(l_shipdate as date) as flight_date",
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    ordered = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    joined = (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    if alike:
        joined = joined.filter(F.hash(*alike) >= F.lit(-(2**31)))
    # First line items are reported twice; the second report is a day newer and five minutes later.
    return joined.selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "q",
        "flight_date",
        "o_orderdate",
        "s_nationkey",
        "c_nationkey",
        "c_mktsegment",
        "p_brand",
        "unhex(sha2(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, q, "
        f"{_CENTS}), 256)) as digest",
        "explode(if(l_linenumber = 1, array(0, 1), array(0))) as restated",
    )


# What the tables give to a flight, and what they give to it but for its aircraft.
NO_AIRCRAFT = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "q",
    "l_extendedprice",
    "flight_date",
    "o_orderdate",
    "s_nationkey",
    "c_nationkey",
    "c_mktsegment",
)
WHOLE = (*NO_AIRCRAFT, "p_brand")

# The order of NEWEST_FIRST in columns of the basis: a record hash is its digest, then whether it is restated; batch
# and file follow from the order date and from the day, which is part of the key.
BASIS_NEWEST_FIRST = ("ingestion_timestamp", "digest", "restated")


def raw_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Flight feed with text clocks, faulty rows and restated first line items."""
    return reports_of(flight_basis(spark, folder))


def reports_of(basis: DataFrame, *keep: str) -> DataFrame:
    """The raw reports of ``flight_basis``, and the columns ``keep`` of it."""
    terms = basis.selectExpr(
        "*",
        "(l_orderkey * 7 + l_linenumber * 131) % 1440 as m",
        "((l_orderkey * 7 + l_linenumber * 131) % 1440 + 45 + l_suppkey % 400) % 1440 as m2",
        "q - 12 as dd",
        "cast(q - 24 + l_partkey % 33 as int) as ad",
        "(l_orderkey + l_linenumber) % 25 = 0 as canc",
    )

    def cause(number: int) -> str:
        return (
            f"cast(if(not canc and ad > 15 and l_linenumber % 5 = {number}, "
            "ad + 5 * restated, 0) as double)"
        )

    return terms.selectExpr(
        *[c for c in keep if c != "flight_date"],
        "flight_date",
        "upper(substr(c_mktsegment, 1, 2)) as reporting_airline",
        "c_mktsegment as reporting_airline_name",
        "concat('N', lpad(l_partkey % 1000, 3, '0'), if(l_partkey % 4 = 0, 'B0', "
        "concat('B', lpad(replace(p_brand, 'Brand#', ''), 3, '0')))) as tail_number",
        "if(l_partkey % 97 = 0, null, cast(l_orderkey % 10000 as string)) as flight_number",
        "if(l_suppkey % 53 = 0, '', concat(' n', lpad(s_nationkey, 2, '0'))) as origin_airport",
        "cast(10000 + s_nationkey as string) as origin_airport_seq_id",
        "concat('City ', s_nationkey) as origin_city_name",
        "concat('S', s_nationkey % 10) as origin_state_abbr",
        "concat('N', lpad(c_nationkey, 2, '0')) as dest_airport",
        "cast(20000 + c_nationkey as string) as dest_airport_seq_id",
        "concat('City ', c_nationkey) as dest_city_name",
        "concat('S', c_nationkey % 10) as dest_state_abbr",
        f"if(l_partkey % 89 = 0, '2400', {_clock('m')}) as crs_dep_time",
        f"if(canc or l_partkey % 71 = 0, '', {_clock('(m + dd + 1440) % 1440')}) as dep_time",
        "cast(if(canc, null, dd + 5 * restated) as double) as dep_delay_minutes",
        "cast(l_partkey % 18 + 11 as double) as taxi_out",
        "cast(l_partkey % 12 + 5 as double) as taxi_in",
        f"if(l_partkey % 83 = 0, '9999', {_clock('m2')}) as crs_arr_time",
        f"if(canc or l_partkey % 73 = 0, '', {_clock('(m2 + ad + 1440) % 1440')}) as arr_time",
        "cast(if(canc, null, ad + 5 * restated) as double) as arr_delay_minutes",
        "if(l_partkey % 101 = 0, null, cast(canc as int)) as cancelled",
        "nullif(if(canc, element_at(array('A', 'B', 'C', 'D', ''), "
        "cast(l_suppkey % 5 as int) + 1), ''), '') as cancellation_code",
        "cast(not canc and l_partkey % 67 = 0 as int) as diverted",
        "cast(l_suppkey % 2500 + 100 as double) as distance_miles",
        f"{cause(0)} as carrier_delay",
        f"{cause(1)} as weather_delay",
        f"{cause(2)} as nas_delay",
        f"{cause(3)} as security_delay",
        f"{cause(4)} as late_aircraft_delay",
        "concat('line ', l_orderkey, '/', l_linenumber) as raw_record",
        "concat('flights_', date_format(flight_date, 'yyyy-MM'), '.csv') as source_file_name",
        "'star_feed' as source_system",
        "cast(o_orderdate as timestamp) + make_dt_interval(restated) as ingestion_timestamp",
        "concat('batch_', year(o_orderdate), if(restated = 1, '_r', '')) as batch_id",
        "concat(lower(hex(digest)), if(restated = 1, '|r', '')) as record_hash",
        "date_format(flight_date, 'yyyy-MM') as year_month",
    )


def raw_airports(spark: SparkSession, folder: str) -> DataFrame:
    """Airport reports: many per airport, in mixed case; airport N24 never has its codes."""
    return table(spark, folder, "customer").selectExpr(
        "cast(c_custkey as string) as airport_id",
        "concat(if(c_custkey % 2 = 0, 'KN', 'kn'), lpad(c_nationkey, 2, '0')) as ident",
        "if(c_custkey % 3 = 0, 'large_airport', 'medium_airport') as type",
        "c_name as name",
        "cast(c_nationkey * 3 - 36 as double) as latitude_deg",
        "cast(c_nationkey * 7 - 84 as double) as longitude_deg",
        "cast(c_custkey % 900 as double) as elevation_ft",
        "'na' as continent",
        "lower(concat('c', c_nationkey)) as iso_country",
        "concat('r-', c_nationkey) as iso_region",
        "concat('City ', c_nationkey) as municipality",
        "element_at(array('yes', 'YES', 'no', null), cast(c_custkey % 4 as int) + 1) "
        "as scheduled_service",
        "if(c_custkey % 29 = 0 or c_nationkey = 24, null, concat(if(c_custkey % 2 = 0, 'KN', 'kn'), "
        "lpad(c_nationkey, 2, '0'))) as icao_code",
        "if(c_custkey % 29 = 0 or c_nationkey = 24, null, concat(if(c_custkey % 2 = 0, 'N', 'n'), "
        "lpad(c_nationkey, 2, '0'))) as iata_code",
        "'airports.csv' as source_file_name",
        "'star_airports' as source_system",
        "cast(date_add(date '2020-01-01', cast(c_custkey % 365 as int)) as timestamp) "
        "as ingestion_timestamp",
        "concat('batch_', c_custkey % 7) as batch_id",
        "sha2(concat_ws('|', c_custkey, c_name), 256) as record_hash",
    )


def raw_aircraft(spark: SparkSession, folder: str) -> DataFrame:
    """Aircraft-type reports: one per part, the brand being the type; some without a code."""
    number = "lpad(replace(p_brand, 'Brand#', ''), 3, '0')"
    return table(spark, folder, "part").selectExpr(
        f"if(p_partkey % 31 = 0, null, concat(if(p_partkey % 2 = 0, 'B', 'b'), {number})) "
        "as aircraft_code",
        "p_brand as aircraft_name",
        f"concat('t', {number}) as iata_code",
        f"concat('b', {number}) as icao_code",
        "cast(date_add(date '2020-01-01', cast(p_partkey % 365 as int)) as timestamp) "
        "as ingestion_timestamp",
        "concat('batch_', p_partkey % 7) as batch_id",
        "sha2(concat_ws('|', p_partkey, p_name), 256) as record_hash",
    )


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Station observations: one per event, several events sharing an hour and a station."""
    cents = "cast(round(value * 100) as bigint)"
    return table(spark, folder, "events").selectExpr(
        "if(user_id % 41 = 0, null, concat(if(event_id % 2 = 0, 'KN', 'kn'), "
        "lpad(user_id % 25, 2, '0'))) as station_id",
        "date_trunc('HOUR', cast(ts as timestamp)) as observation_time",
        "cast(ts as date) as observation_date",
        f"cast({cents} % 40 as double) as temp_c",
        f"cast({cents} % 20 as double) as dewpoint_c",
        f"cast({cents} % 36 * 10 as int) as wind_dir_degrees",
        f"cast({cents} % 45 as double) as wind_speed_kt",
        f"cast({cents} % 60 as double) as wind_gust_kt",
        f"cast({cents} % 10 + 1 as double) as visibility_statute_mi",
        f"cast({cents} % 100 + 2920 as double) / 100 as altim_in_hg",
        "element_at(array('vfr', 'MVFR', 'ifr', 'LIFR'), cast(event_id % 4 as int) + 1) "
        "as flight_category",
        f"cast({cents} % 15 as double) / 100 as precip_in",
        "element_at(array('clr', 'FEW', 'sct', 'BKN', 'ovc'), cast(event_id % 5 as int) + 1) "
        "as sky_cover",
        "cast(ts as timestamp) as ingestion_timestamp",
        "concat('batch_', event_type) as batch_id",
        "sha2(concat_ws('|', event_id, user_id, event_type), 256) as record_hash",
    )


def movement_weather(flights: DataFrame) -> DataFrame:
    """One observation ahead of every scheduled movement of ``flights`` (raw).

    Departures are observed at the origin, arrivals at the destination; a station is observed
    once per moment and reports the worst weather of the flights it serves then.
    """
    day = F.col("flight_date")
    bad = F.coalesce((F.col("weather_delay") > 0) | (F.col("cancellation_code") == "B"), F.lit(False))

    def movement(airport: str, clock: str) -> Column:
        return F.struct(
            station_code(F.col(airport)).alias("airport"),
            number_timestamp(day, F.col(f"__{clock}")).alias("moment"),
        )

    numbered = flights.withColumns({f"__{c}": clock_number(F.col(c)) for c in ("crs_dep_time", "crs_arr_time")})
    moments = numbered.select(
        bad.cast("int").alias("bad"),
        F.inline(
            F.array(
                movement("origin_airport", "crs_dep_time"),
                movement("dest_airport", "crs_arr_time"),
            )
        ),
    ).filter("airport <> '' and moment is not null")
    observed = moments.groupBy("airport", "moment").agg(F.max("bad").alias("bad"))
    ahead = F.col("moment") - F.make_dt_interval(mins=F.lit(OBSERVATION_LEAD_MINUTES))
    return observed.select(
        F.concat(F.lit("K"), "airport").alias("station_id"),
        ahead.alias("observation_time"),
        ahead.cast("date").alias("observation_date"),
        F.when(F.col("bad") == 1, "IFR").otherwise("VFR").alias("flight_category"),
        F.when(F.col("bad") == 1, 18.0).otherwise(5.0).alias("wind_speed_kt"),
        F.when(F.col("bad") == 1, 1.4).otherwise(10.0).alias("visibility_statute_mi"),
    )
