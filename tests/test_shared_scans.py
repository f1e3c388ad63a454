"""Queries that read the flights in several ways exchange line items and orders once, observations once."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tarmac.plans.weather import latest_observations

FOLDER = "/root/testdata/sf0.001"
LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def exchanges_of(spark, name):
    usual = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "-1")
    try:
        df = contract.queries()[name](spark, FOLDER)
        df.collect()
    finally:
        spark.conf.set(LIMIT, usual)
    final = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in final[: final.index("== Initial Plan ==")].splitlines() if "hashpartitioning" in x]


@pytest.mark.parametrize("name", ["flights_restated", "weather_asof", "weather_asof_arrivals"])
def test_line_items_and_orders_are_exchanged_once(spark, name):
    exchanges = exchanges_of(spark, name)
    for key in ("l_partkey", "l_orderkey", "o_orderkey"):
        own = [x for x in exchanges if f"hashpartitioning({key}#" in x]
        assert len([x for x in own if "ReusedExchange" not in x]) == 1
        assert key == "l_partkey" or len(own) > 1
    assert not [x for x in exchanges if re.search(r"hashpartitioning\(station_id#\d+, minute#", x)]


def test_of_observations_at_one_time_the_greatest_counts(spark):
    rows = [("A", 600, c, w, v) for c, w, v in (("IFR", 1.0, 9.0), ("VFR", None, 2.0), ("VFR", 3.0, None), (None, 9.0, 9.0))]
    rows += [("A", 900, None, None, None), ("B", 600, None, 1.0, 1.0), ("B", 600, None, 1.0, 2.0), ("B", None, "VFR", 1.0, 1.0)]
    weather = spark.createDataFrame(
        rows, "station_id string, t long, flight_category string, wind_speed_kt double, visibility_statute_mi double"
    ).withColumn("observation_time", F.timestamp_seconds("t"))
    asked = [(s, t) for s in ("A", "B", None) for t in (599, 600, 899, 900, 4500, 4501, None)]
    probes = spark.createDataFrame(asked, "station_id string, t long").withColumn("minute", F.timestamp_seconds("t"))
    for kind in ("timestamp", "timestamp_ntz"):
        seen = weather.withColumn("observation_time", F.col("observation_time").cast(kind))
        found = latest_observations(probes, seen, 60)
        assert found.schema["observation"].dataType["observation_time"].dataType.simpleString() == kind
        time = F.unix_seconds(F.col("observation.observation_time").cast("timestamp")).alias("at")
        got = {(r[0], r[1]): tuple(r)[2:] for r in found.select("station_id", "t", time, *["observation." + c for c in weather.columns[2:5]]).collect()}
        a, empty, b = (600, "VFR", 3.0, None), (900, None, None, None), (600, None, 1.0, 2.0)
        none = (None,) * 4
        want = {(s, t): none for s, t in asked}
        want |= {("A", 600): a, ("A", 899): a, ("A", 900): empty, ("A", 4500): empty}
        want |= {("B", t): b for t in (600, 899, 900)}
        assert got == want
