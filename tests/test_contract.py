"""Every registered query against its SQL counterpart, and the plans behind them."""

from __future__ import annotations

import re

import pytest
from parity import differences, duck

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
# The text operators, where present, bring their own tests.
FEED_QUERIES = [name for name, build in contract.queries().items() if build.__module__ == contract.__name__]


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_each_query_has_its_sql():
    assert set(FEED_QUERIES) <= set(contract.oracle_sql())


PLAIN_OPERATORS_ONLY = ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", FEED_QUERIES)
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    found = differences(df, con, contract.oracle_sql()[name])
    assert not found, "\n".join(found)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in PLAIN_OPERATORS_ONLY if x in plan]


def plan_of(spark, name):
    return contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["otp_daily", "airport_delay", "flights_clean"])
def test_flights_are_scanned_once_and_hot_keys_cut_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange", plan.index("WindowGroupLimit")) < plan.rindex("WindowGroupLimit")


SCANS = {
    "gold_counts": 1,
    "silver_counts": 1,
    "weather_asof": 2,
    "weather_asof_arrivals": 2,
    "otp_monthly": 1,
    "route_reference_merged": 1,
    "known_airports_reasons": 1,
}


@pytest.mark.parametrize("name", SCANS)
def test_flights_are_derived_no_more_often_than_needed(spark, name):
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan_of(spark, name))) == SCANS[name]


def test_only_needed_columns_are_read(spark):
    plan = plan_of(spark, "weather_clean")
    assert "props" not in re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "l_tax" not in plan_of(spark, "flights_clean")


def test_entry(spark):
    assert contract.entry(spark).count() > 0
