from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import FLIGHTS, flight, write_csv, write_json

from tarmac.schemas import TABLES, rejected_name
from tarmac.sinks.monthly import export_monthly
from tarmac.operators.align import lenient_cast
from tarmac.sources import feeds
from tarmac.sources.feeds import (
    FeedSpec,
    csv_headers,
    feed_catalogue,
    feed_spec,
    normalize_format,
    parse_json_lines,
    scan,
)
from tarmac.sources.rescue import (
    PAYLOAD,
    RESCUED_COLUMN,
    rejected_records,
    split_rescued,
    type_fields,
)


def test_formats():
    assert [normalize_format(x) for x in (" CSV ", "json", "JsonL")] == ["csv", "json", "json"]
    with pytest.raises(ValueError, match="parquet"):
        normalize_format("parquet")


def test_catalogue_variants():
    kinds = lambda v: [s.source_format for s in feed_catalogue("/lake/", v)]
    assert kinds("csv") == ["csv"] * 4 and kinds("jsonl") == ["jsonl"] * 4
    assert kinds("mixed") == ["csv", "csv", "csv", "jsonl"]
    first = feed_catalogue("/lake/", "csv")[0]
    assert first.source_path == "/lake/data/raw/flight_operations"
    assert first.rejected_table == "bronze.flight_operations_rejected"
    assert first.source_file_extension == ".csv" and first.write_mode == "append"
    with pytest.raises(ValueError, match="xml"):
        feed_catalogue("/lake", "xml")


def test_rejected_names():
    assert rejected_name("bronze.airports_raw") == "bronze.airports_rejected"
    assert rejected_name("bronze.airports") == "bronze.airports_rejected"


def typed(spark, spec):
    schema = TABLES[spec.target_table].schema
    texts, fresh = scan(spark, spec, schema)
    return type_fields(texts, schema, new_columns=fresh, rescued_column=spec.rescued_column)


def spec_of(root, fmt, **changes):
    spec = feed_spec(str(root), "flight_operations", fmt)
    return spec.__class__(**{**spec.__dict__, **changes})


def test_csv_and_json_feeds_read_alike(spark, feed_root):
    rows = [typed(spark, spec_of(feed_root, f)) for f in ("csv", "jsonl")]
    csv_rows, json_rows = (df.filter(F.col(RESCUED_COLUMN).isNull()) for df in rows)
    names = [c for c in FLIGHTS[0] if c != "raw_record"]
    assert csv_rows.count() == json_rows.count() == 8
    as_set = lambda df: {tuple(r) for r in df.select(names).collect()}
    assert as_set(csv_rows) == as_set(json_rows)
    first = csv_rows.filter("flight_number = '11'").first()
    assert (first["crs_dep_time"], first["year_month"]) == ("0900", "2025-03")
    assert (first["taxi_out"], first["cancelled"], first["cancellation_code"]) == (11.0, 0, None)
    assert json.loads(first["raw_record"])["flight_number"] == "11"


def test_values_that_do_not_fit_are_rescued(spark, tmp_path):
    rows = [flight(), flight(flight_number="2", taxi_in="abc", diverted="x"),
            flight(flight_number="3", cancelled="0.0", taxi_out=" ", ingestion_timestamp="soon")]
    folder = tmp_path / "data" / "raw" / "flight_operations"
    write_csv(folder, "a.csv", rows)
    with (folder / "a.csv").open("a") as out:
        out.write("2025-03-01,UA\n")
        out.write((folder / "a.csv").read_text().splitlines()[1] + ",surplus\n")
    df = typed(spark, spec_of(tmp_path, "csv"))
    # A narrow query must see the short and the long line as well.
    assert df.filter(F.col(RESCUED_COLUMN).isNotNull()).select("flight_date").count() == 3
    fit, misfits = split_rescued(df)
    got = {r["flight_number"]: r for r in fit.collect()}
    assert set(got) == {"1", "3"} and got["3"]["cancelled"] == 0 and got["3"]["taxi_out"] is None
    rescued = [json.loads(r[RESCUED_COLUMN]) for r in misfits.collect()]
    assert {"taxi_in": "abc", "diverted": "x"} in rescued
    corrupt = [r["_corrupt_record"] for r in rescued if "_corrupt_record" in r]
    assert sorted(c.endswith("surplus") for c in corrupt) == [False, True]
    record = rejected_records(
        misfits.filter("flight_number = '2'"), source_table="t", source_system="s",
        file_name=F.col("_source_file"), batch_id="b",
    ).first()
    assert record["source_file_name"] == "a.csv" and record["batch_id"] == "b"
    assert json.loads(record["raw_payload"])["taxi_in"] == "abc"


def test_json_lines_that_do_not_parse(spark, tmp_path):
    folder = tmp_path / "data" / "raw_json" / "flight_operations"
    write_json(folder, "a.jsonl", [flight(), {**flight(), "cancelled": {"by": ["x"]}}])
    with (folder / "a.jsonl").open("a") as out:
        out.write('{"flight_number": "9"\n\n[1, 2]\n')
    fit, misfits = split_rescued(typed(spark, spec_of(tmp_path, "jsonl")))
    assert fit.count() == 1
    rescued = sorted(r[RESCUED_COLUMN] for r in misfits.collect())
    assert [json.loads(r) for r in rescued] == [
        {"_corrupt_record": "[1, 2]"}, {"_corrupt_record": '{"flight_number": "9"'},
        {"cancelled": '{"by":["x"]}'},
    ]


@pytest.mark.parametrize("fmt", ["csv", "jsonl"])
def test_new_fields_grow_the_schema_or_are_rejected(spark, tmp_path, fmt):
    folder = tmp_path / "data" / ("raw" if fmt == "csv" else "raw_json") / "flight_operations"
    write = write_csv if fmt == "csv" else write_json
    write(folder, f"a.{fmt}", [flight(gate="A1"), flight(flight_number="2", gate="")])
    grown = typed(spark, spec_of(tmp_path, fmt))
    assert {r["gate"] for r in grown.collect()} == {"A1", None}
    fixed = typed(spark, spec_of(tmp_path, fmt, allow_schema_evolution=False))
    fit, misfits = split_rescued(fixed)
    assert "gate" not in fit.columns
    if fmt == "csv":  # a blank is no value
        assert [r["flight_number"] for r in fit.collect()] == ["2"]
    assert '{"gate":"A1"}' in [r[RESCUED_COLUMN] for r in misfits.collect()]


def test_split_without_rescued_column(spark):
    df = spark.range(3)
    fit, misfits = split_rescued(df)
    assert fit.count() == 3 and misfits.count() == 0
    assert PAYLOAD not in fit.columns


def test_monthly_export_reads_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [("2025-01", 'say "x", y', 1), ("2025-02", None, 2)], "year_month string, t string, n int"
    )
    folders = export_monthly(rows, str(tmp_path / "out"))
    want = {tuple(r) for r in rows.collect()}
    back = spark.read.json(folders["json"]).select("year_month", "t", F.col("n").cast("int"))
    assert {tuple(r) for r in back.collect()} == want
    schema = "year_month string, t string, n int"
    text = spark.read.csv(folders["csv"], header=True, schema=schema, escape='"')
    assert {tuple(r) for r in text.select("year_month", "t", "n").collect()} == want


def test_files_with_different_headers_are_matched_by_name(spark, tmp_path):
    spec = feed_spec(str(tmp_path), "airports", "csv")
    folder = tmp_path / "data" / "raw" / "airports"
    write_csv(folder, "2025-01.csv", [{"ident": "A", "name": "One, first"}, {"ident": "B", "name": ""}])
    write_csv(folder, "2025 02+.csv", [{"name": "Three", "tower": "yes", "ident": "C"}])
    write_csv(folder, "2025-03.csv", [{"ident": "D", "name": "Four"}])
    declared = TABLES[spec.target_table].schema
    rows, fresh = scan(spark, spec, declared)
    assert fresh == ["tower"]
    got = {(r["ident"], r["name"], r["tower"], r["_source_file"]) for r in rows.collect()}
    assert got == {
        ("A", "One, first", None, "2025-01.csv"), ("B", None, None, "2025-01.csv"),
        ("C", "Three", "yes", "2025 02+.csv"), ("D", "Four", None, "2025-03.csv"),
    }
    assert len(csv_headers(spark, spec)) == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2  # one per distinct header
    # A line that does not fit the header of its own file is still rejected.
    with (folder / "2025 02+.csv").open("a") as out:
        out.write("Five,no\n")
    fixed = scan(spark, FeedSpec(**{**spec.__dict__, "allow_schema_evolution": False}), declared)[0]
    rescued = [r[RESCUED_COLUMN] for r in type_fields(fixed, declared).collect()]
    assert sorted(x for x in rescued if x) == ['{"_corrupt_record":"Five,no"}', '{"tower":"yes"}']


def test_each_json_line_is_parsed_once(spark):
    lines = spark.createDataFrame(
        [('{"a": 1, "b": {"x": [1]}, "c": "q"}', "f"), ("[1]", "f"), ('{"a": ', "f"), ('{"a": "z", "a": 2}', "f"), ("null", "f")],
        "value string, _source_file string",
    )
    rows = parse_json_lines(lines, ["a", "b"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json(") == 1 and "json_object_keys" not in plan
    got = [(r["a"], r["b"], r["_unknown_fields"], r["_corrupt_record"]) for r in rows.collect()]
    assert got == [
        ("1", '{"x":[1]}', {"c": "q"}, None), (None, None, None, "[1]"), (None, None, None, '{"a": '),
        ("z", None, None, None), (None, None, None, "null"),
    ]


def test_a_feed_whose_keys_are_data_does_not_grow(spark, monkeypatch):
    monkeypatch.setattr(feeds, "MOST_NEW_COLUMNS", 5)
    lines = spark.range(10).selectExpr("""concat('{"k', id, '": 1}') as value""", "'f' as _source_file")
    with pytest.raises(ValueError, match="more than 5 new keys"):
        feeds.json_new_keys(lines, [])


def test_whole_numbers_keep_every_digit(spark):
    texts = ["9007199254740993.0", "9223372036854775807.0", "12.5", "1e3", "3.", "-7.000", "9223372036854775808", "x", "NaN"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(lenient_cast(F.col("t"), T.LongType()))
    assert [r[0] for r in rows.collect()] == [9007199254740993, 2**63 - 1, None, 1000, 3, -7, None, None, None]
