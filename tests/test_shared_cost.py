"""What the step that all flight queries share costs: sorts, exchanges and date arithmetic."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tarmac.functions.clock import clock_timestamp
from tarmac.operators.latest import keep_latest, superseded_derived
from tarmac.sources import starfeed

FOLDER = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["otp_daily", "route_delay_merged", "gold_counts", "route_reference"])
def test_flights_are_told_apart_by_one_number(spark, name):
    plan = plan_of(spark, name)
    assert "make_timestamp" not in plan
    assert re.search(r"Sort \[__key_hash#\d+ ASC NULLS FIRST, flight_date", plan)


def test_retraction_exchanges_flights_once(spark):
    plan = plan_of(spark, "flights_retracted")
    assert "LeftAnti" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\([^\n]*flight_date", plan)) == 1


def test_superseded_rows_are_those_that_lost_to_a_later_batch(spark):
    rows = [(i, None if i % 7 == 0 else i % 11, None if i % 13 == 0 else i * 37 % 53, i % 5 == 0) for i in range(300)]
    rows += [(i, 99, i, None) for i in range(5)]
    basis = spark.createDataFrame(rows, "n int, k int, t int, late boolean")

    def derive(df):
        return df.select("*", F.concat(F.lit("k"), F.col("k")).alias("key"), (F.col("n") * 2).alias("twice"))

    got = superseded_derived(basis, derive, ("key",), ~F.col("late"), ("t", "n"), carried=("twice",))
    wide = derive(basis)
    old, now = keep_latest(wide.filter(~F.col("late")), ("key",), ("t", "n")), keep_latest(wide, ("key",), ("t", "n"))
    want = old.join(now.select(F.col("n").alias("m")), F.col("n") == F.col("m"), "left_anti")
    assert got.columns == wide.columns
    assert 0 < got.count() < old.count()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_moments_are_those_of_the_zone(spark):
    clocks = ["0610", "0000", "2359", "2400", "1260", "x", None, "7"]
    frame = spark.createDataFrame([(d, c) for d in ("2024-03-31", "1969-12-31", "2024-10-27") for c in clocks], "d string, c string")
    usual = spark.conf.get("spark.sql.session.timeZone")

    def seen():
        moment = clock_timestamp(F.col("d").cast("date"), F.col("c"))
        return [r[0] for r in frame.select(moment.cast("string")).collect()]

    try:
        here = seen()
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        assert seen() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", usual)
    assert here[:5] == ["2024-03-31 06:10:00", "2024-03-31 00:00:00", "2024-03-31 23:59:00", None, None]


def test_cents_and_clocks_of_the_feed(spark):
    prices = [0.125, 0.005, 1.005, 2.675, -0.005, -1.995, 12345.67, 99999999.995, 1e15, 0.0049999999999999996, None]
    cents = spark.createDataFrame([(p,) for p in prices], "l_extendedprice double").selectExpr(
        f"{starfeed._CENTS} as got", "cast(round(l_extendedprice * 100) as bigint) as want"
    )
    assert all(r.got == r.want for r in cents.collect())
    clocks = spark.createDataFrame([(m,) for m in (*range(1440), -1, -70, -1439, None)], "m long").selectExpr(
        f"{starfeed._clock('m')} as got", "concat(lpad(m div 60, 2, '0'), lpad(m % 60, 2, '0')) as want"
    )
    assert all(r.got == r.want for r in clocks.collect())
