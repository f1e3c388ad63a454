"""Steps that many queries share: what they exchange, and how often."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tarmac.operators.latest import keep_latest, keep_latest_derived
from tarmac.plans.weather import latest_observations

FOLDER = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def sorted_before_the_exchange(plan):
    """The columns that the last projection before the de-duplication puts out."""
    below = plan[plan.rindex("WindowGroupLimit") :]
    return re.search(r"Project \[(.*)\]", below).group(1)


@pytest.mark.parametrize("name", ["flights_clean", "flights_quarantine", "latest_record_dedupe"])
def test_only_what_the_flights_follow_from_is_sorted_and_exchanged(spark, name):
    columns = sorted_before_the_exchange(plan_of(spark, name))
    assert "digest" in columns
    assert not [c for c in ("record_hash", "raw_record", "city_name", "taxi", "carrier_delay") if c in columns]


def test_derived_rows_give_the_same_survivors(spark):
    rows = [(i, i % 3, i % 5, None if i % 4 == 0 else i % 2) for i in range(60)]
    basis = spark.createDataFrame(rows, "n int, a int, b int, c int")

    def derive(df):
        return df.select("*", F.concat(F.lit("k"), F.col("a")).alias("k"), (F.col("n") * 7 % 11).alias("t"))

    keys, newest = ("k", "c"), ("t", "n")
    got = keep_latest_derived(basis, derive, keys, newest, carried=("t",))
    want = keep_latest(derive(basis), keys, newest)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_restating_exchanges_no_whole_flights_by_month(spark):
    plan = plan_of(spark, "flights_restated")
    assert not re.search(r"hashpartitioning\((coalesce\()?(year_month|date_format)", plan)


@pytest.mark.parametrize("name", ["gold_gate", "silver_gate", "reconcile_airports"])
def test_flights_read_several_times_are_exchanged_once(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("== Initial Plan ==")]
    exchanges = [x for x in final.splitlines() if re.search(r"hashpartitioning\(flight_date#\d+, __reporting", x)]
    assert len([x for x in exchanges if "ReusedExchange" not in x]) == 1 < len(exchanges)


@pytest.mark.parametrize("name", ["aircraft_perf", "aircraft_perf_merged"])
def test_flights_are_not_dealt_by_aircraft_code(spark, name):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = plan_of(spark, name)
    finally:
        spark.conf.set(limit, usual)
    assert not re.search(r"SortMergeJoin \[aircraft_code", plan)


def test_each_clock_is_parsed_once(spark):
    plan = plan_of(spark, "overnight_roll")
    for clock in ("crs_dep_time", "crs_arr_time", "dep_time", "arr_time"):
        assert len(re.findall(rf"try_cast\({clock}#", plan)) == 1
    assert len(re.findall(r"try_cast\(crs_\w+_time#", plan_of(spark, "movement_weather"))) == 2


def test_batches_are_not_dealt_by_their_id(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = plan_of(spark, "batch_replace")
    finally:
        spark.conf.set(limit, usual)
    assert not re.search(r"SortMergeJoin \[batch_id", plan)


@pytest.mark.parametrize("age", [60, 120])
def test_observations_are_placed_in_two_periods_at_most(spark, age):
    """Against brute force, around the ends of periods, which are as long as eight times the age."""
    start = 1_000_000_000 // (8 * 60 * age) * 8 * 60 * age
    seen = [(s, start + d * 60 + 1) for s in ("A", "B") for d in (*range(-3 * age, 3 * age, 7), 8 * age - 1, 8 * age)]
    asked = [(s, start + d * 60) for s in ("A", "B", "C", None) for d in range(-3 * age, 9 * age + 99, 11)]
    moment = F.timestamp_seconds("t")
    weather = spark.createDataFrame(seen, "station_id string, t long").select(
        "station_id",
        moment.alias("observation_time"),
        F.col("t").cast("string").alias("flight_category"),
        F.lit(1.0).alias("wind_speed_kt"),
        F.lit(1.0).alias("visibility_statute_mi"),
    )
    probes = spark.createDataFrame(asked, "station_id string, t long").withColumn("minute", moment)
    found = latest_observations(probes, weather, age)
    got = sorted((str(r["station_id"]), r["t"], r["observation"] and int(r["observation"][1])) for r in found.collect())
    want = [
        (str(s), t, max((o for p, o in seen if p == s and t - age * 60 <= o <= t), default=None)) for s, t in asked
    ]
    assert got == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "date_trunc(hour" not in plan
