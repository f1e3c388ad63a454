from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.clock import clock_timestamp, roll_overnight
from tarmac.functions.codes import cancellation_reason, tail_code
from tarmac.functions.fingerprint import with_fingerprint
from tarmac.operators.align import align, new_fields
from tarmac.operators.batches import batch_ids, replace_batches
from tarmac.operators.latest import keep_latest


def _column(spark, values, expr, dtype="string"):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("v", T.StringType())])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    return [r[0] for r in df.orderBy("n").select(expr.cast(dtype)).collect()]


def test_clock_strings(spark):
    cases = {
        "0610": "06:10", "610": "06:10", "06:10": "06:10", " 5 ": "00:05", "12345": "12:34",
        "2359": "23:59", "2400": None, "6100": None, "0660": None, "abc": None, "": None,
        "  ": None, None: None, "610.0": None,
    }
    day = F.lit("2025-03-01").cast("date")
    got = _column(spark, list(cases), clock_timestamp(day, F.col("v")))
    assert got == [v and f"2025-03-01 {v}:00" for v in cases.values()]
    no_day = F.lit(None).cast("date")
    assert _column(spark, ["0610"], clock_timestamp(no_day, F.col("v"))) == [None]


def test_roll_overnight(spark):
    start = F.lit("2025-03-01 18:40:00").cast("timestamp")
    ends = ["2025-03-01 18:40:00", "2025-03-01 18:39:00", None]
    got = _column(spark, ends, roll_overnight(start, F.col("v").cast("timestamp")))
    assert got == ["2025-03-01 18:40:00", "2025-03-02 18:39:00", None]


def test_tail_codes(spark):
    tails = ["N12AB789", "N-A35K", "n532b7", "", None, "N532B7"]
    assert _column(spark, tails, tail_code(F.col("v"))) == ["B789", "A35K", "", "", None, "32B7"]


def test_cancellation_reasons(spark):
    codes = ["A", "B", "C", "D", "Z", None, "a"]
    assert _column(spark, codes, cancellation_reason(F.col("v"))) == [
        "Carrier", "Weather", "National Air System", "Security", "Unknown", "Unknown", "Unknown",
    ]


def test_fingerprint_ignores_column_order_and_sees_nulls(spark):
    a = spark.sql("select 1 as x, cast(null as string) as y")
    b = a.select("y", "x")
    first, second = with_fingerprint(a).first(), with_fingerprint(b).first()
    assert first["raw_record"] == '{"x":1,"y":null}'
    assert first["record_hash"] == second["record_hash"]
    other = with_fingerprint(spark.sql("select 1 as x, '' as y")).first()
    assert other["record_hash"] != first["record_hash"]


def test_align_orders_casts_fills_and_drops(spark):
    df = spark.sql("select 'x' as extra, '7' as b, 'n/a' as a, '3.0' as d")
    schema = T.StructType.fromDDL("a INT, b BIGINT, c DATE, d INT")
    assert align(df, schema, lenient=True).first().asDict() == {"a": None, "b": 7, "c": None, "d": 3}
    assert align(df, schema, skip=("a", "d")).columns == ["b", "c"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        align(df, schema).collect()


def test_new_fields_compare_names_exactly_and_respect_protection(spark):
    df = spark.sql("select 1 as a, 2 as A, 3 as b, 4 as _rescued")
    schema = T.StructType.fromDDL("a INT")
    assert [f.name for f in new_fields(df, schema, protected=("_rescued",))] == ["A", "b"]


def test_latest_record_wins_whatever_the_partitioning(spark):
    rows = [
        ("k1", "2025-01-01", "b", "batch_1"), ("k1", "2025-01-02", "a", "batch_1"),
        ("k1", None, "z", "batch_1"),
        ("k2", "2025-01-01", "a", "batch_1"), ("k2", "2025-01-01", "b", "batch_1"),
        ("k3", "2025-01-01", "a", "batch_1"), ("k3", "2025-01-01", "a", "batch_2"),
        (None, "2025-01-01", "a", "batch_1"), (None, "2025-01-02", "a", "batch_1"),
    ]
    df = spark.createDataFrame(
        rows, "k string, ingestion_timestamp string, record_hash string, batch_id string"
    )
    want = {(None, "2025-01-02", "a", "batch_1"), ("k1", "2025-01-02", "a", "batch_1"),
            ("k2", "2025-01-01", "b", "batch_1"), ("k3", "2025-01-01", "a", "batch_2")}
    for parts in (1, 3, 7):
        got = keep_latest(df.repartition(parts), ("k",)).collect()
        assert {tuple(r) for r in got} == want and len(got) == 4


def test_replace_batches(spark):
    schema = "batch_id string, v int"
    old = spark.createDataFrame([("o'b", 1), ("o'b", 2), ("other", 3), (None, 4)], schema)
    new = spark.createDataFrame([("o'b", 9), (None, 5)], schema)
    got = sorted(r["v"] for r in replace_batches(old, new).collect())
    assert got == [3, 4, 5, 9]
    assert [r["batch_id"] for r in batch_ids(new).collect()] == ["o'b"]
    assert batch_ids(new.drop("batch_id")).count() == 0


def test_fractions_do_not_fit_whole_numbers(spark):
    from tarmac.operators.align import lenient_cast

    rows = spark.createDataFrame([(x,) for x in ("3", "3.0", "3.7", "0.4", "-2.0", "x", None, "9007199254740993")], "a string")
    got = [r[0] for r in rows.select(lenient_cast(rows["a"], T.LongType())).collect()]
    assert got == [3, 3, None, None, -2, None, None, 9007199254740993]
