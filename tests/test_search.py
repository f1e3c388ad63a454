from __future__ import annotations

import pytest

from tarmac.plans.search import best_match, catalog_tables, lake_tables, search_tables
from tarmac.sinks.lake import Lake

ROWS = [
    ("main", "s", "old_orders", "MANAGED", 0),
    ("main", "s", "orders_2024", "MANAGED", 0),
    ("main", "t", "Orders", "VIEW", 0),
    ("main", "a", "orders", "MANAGED", 0),
    ("legacy", "z", "orders", "MANAGED", 1),
    ("legacy", "b", "all_orders", "TEMPORARY", 1),
    ("legacy", "b", "flights", "MANAGED", 1),
]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(
        ROWS, "catalog string, schema string, table string, table_type string, source_rank int"
    )


def paths(df):
    return [f"{r['catalog']}.{r['schema']}.{r['table']}" for r in df.collect()]


def test_blank_name_is_refused(tables):
    with pytest.raises(ValueError, match="is blank"):
        search_tables(tables, "  ")


def test_exact_then_prefix_then_elsewhere(tables):
    want = ["main.a.orders", "main.t.Orders", "main.s.orders_2024", "main.s.old_orders"]
    assert paths(search_tables(tables, " ORDERS ")) == want
    assert paths(search_tables(tables, "orders", exact=True)) == want[:2]


def test_secondary_follows_in_listing_order_within_the_limit(tables):
    both = paths(search_tables(tables, "orders", include_secondary=True))
    assert both[4:] == ["legacy.b.all_orders", "legacy.z.orders"]
    assert paths(search_tables(tables, "orders", include_secondary=True, limit=5)) == both[:5]


def test_best_match_prefers_exact_over_source(tables):
    best = lambda *a, **k: [r["full_path"] for r in best_match(tables, *a, **k).collect()]
    assert best("orders") == ["main.a.orders"]
    assert best("flights") == [] and best("flights", include_secondary=True) == ["legacy.b.flights"]
    assert best("order", include_secondary=True) == ["main.a.orders"]


def test_listings(spark, tmp_path):
    spark.range(1).createOrReplaceTempView("search_probe")
    assert search_tables(catalog_tables(spark), "search_probe").first()["table_type"] == "TEMPORARY"
    lake = Lake(spark, str(tmp_path))
    lake.table("gold.cancellation_summary").create()
    assert paths(lake_tables(lake)) == ["lake.gold.cancellation_summary"]
