"""The three jobs end to end: contents, reruns, failures, audit, schema growth."""

from __future__ import annotations

import json
import re
import shutil

import pytest
from pyspark.sql import functions as F
from samples import FLIGHTS, flight, write_csv, write_json

from tarmac.plans import checks, gold, jobs, silver
from tarmac.plans.jobs import IngestJob, RefineJob, ReportJob, create_all
from tarmac.schemas import TABLES
from tarmac.sinks.audit import AuditLog
from tarmac.sinks.lake import Lake, LakeTable
from tarmac.sources.feeds import feed_catalogue, feed_spec, scan
from tarmac.streaming.filedrop import ingest_stream

RAW, REJECTED = "bronze.flight_operations_raw", "bronze.flight_operations_rejected"


@pytest.fixture(scope="module")
def empty_lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty") / "lake"
    create_all(spark, str(root))
    return root


@pytest.fixture
def lake(spark, tmp_path, empty_lake):
    """A lake with all tables, still empty; nothing in it names absolute paths, so a copy will do."""
    shutil.copytree(empty_lake, tmp_path / "lake")
    return Lake(spark, str(tmp_path / "lake"))


def flights_spec(root, fmt="csv"):
    return feed_spec(str(root), "flight_operations", fmt)


def write_flights(root, rows, name="a.csv"):
    write_csv(root / "data" / "raw" / "flight_operations", name, rows)


def content(lake, table, *drop):
    return sorted(map(str, lake.read(table).drop(*drop).collect()))


def test_whole_pipeline_on_the_sample(spark, lake, feed_root):
    specs = [s for s in feed_catalogue(str(feed_root), "csv") if "weather" not in s.name]
    loaded = IngestJob(lake).run(specs, batch_id="o'b")
    assert [r["rows_written"] for r in loaded] == [8, 5, 3]
    refined = {r["target_table"]: r["rows_written"] for r in RefineJob(lake).run()}
    assert list(refined.values()) == [5, 3, 0, 8, 0, 8, 8]
    reported = [r["rows_written"] for r in ReportJob(lake).run()]
    assert reported == [2, 8, 12, 2, 8, 2]
    keys = lake.read("silver.flight_operations_clean").select("flight_operation_key")
    assert keys.distinct().count() == 8
    want = {"flight_operations_raw": 8, "route_reference": 8, "on_time_performance_daily": 2}
    report = checks.run_checks(lake, want)
    checks.gate(report)
    assert report.filter("status = 'PASS'").count() >= 15
    # Rerun: same content everywhere.
    before = content(lake, RAW, "ingestion_timestamp"), content(lake, "gold.route_delay_summary", "load_timestamp")
    again = IngestJob(lake).run(specs, batch_id="o'b")
    assert [r["rows_removed"] for r in again] == [8, 5, 3]
    assert RefineJob(lake).run()[3]["rows_removed"] == 8
    ReportJob(lake).run()
    after = content(lake, RAW, "ingestion_timestamp"), content(lake, "gold.route_delay_summary", "load_timestamp")
    assert after == before
    log = AuditLog(spark, lake.root).read()
    assert {r["status"]: r["count"] for r in log.groupBy("status").count().collect()} == {
        "STARTED": 32, "SUCCESS": 32,
    }
    silver_log = log.filter("pipeline_name = 'silver_transformation' and stage_name = 'airports_clean'")
    assert {r["batch_id"] for r in silver_log.collect()} == {"o'b"}
    assert "gold_route_delay_summary" in lake.create_views("gold")
    assert spark.sql("select count(*) from gold_route_delay_summary").first()[0] == 8


def test_rerun_replaces_rejected_rows_too(lake, tmp_path):
    write_flights(tmp_path, [flight(), flight(flight_number="2", taxi_in="abc")])
    job, spec = IngestJob(lake), flights_spec(tmp_path)
    first = job.ingest(spec, batch_id="b1")
    assert (first["rows_written"], first["rows_rescued"]) == (1, 1)
    rejected = lake.read(REJECTED).first()
    assert rejected["rescued_data"] == '{"taxi_in":"abc"}' and rejected["source_file_name"] == "a.csv"
    job.ingest(spec, batch_id="b1")
    assert (lake.read(RAW).count(), lake.read(REJECTED).count()) == (1, 1)
    job.ingest(spec, batch_id="b2")
    assert (lake.read(RAW).count(), lake.read(REJECTED).count()) == (2, 2)
    write_flights(tmp_path, [flight(), flight(flight_number="2", taxi_in="3")])
    repaired = job.ingest(spec, batch_id="b1")
    assert (repaired["rows_written"], repaired["rows_removed"]) == (2, 1)
    assert {r["batch_id"] for r in lake.read(REJECTED).collect()} == {"b2"}
    assert lake.read(RAW).groupBy("batch_id").count().orderBy("batch_id").collect() == [("b1", 2), ("b2", 1)]


def test_batches_named_by_the_feed_and_by_the_run(lake, tmp_path):
    rows = [flight(), {**flight(flight_number="2"), "batch_id": ""}]
    write_flights(tmp_path, rows)
    job, spec = IngestJob(lake), flights_spec(tmp_path)
    job.ingest(spec, run_id="run-1")
    job.ingest(spec, run_id="run-1")
    got = {r["flight_number"]: r["batch_id"] for r in lake.read(RAW).collect()}
    assert got == {"1": "batch_1", "2": "run-1"} and lake.read(RAW).count() == 2


def test_lines_that_name_no_batch_are_replaced_on_rerun(lake, tmp_path):
    write_flights(tmp_path, [flight()])
    with (tmp_path / "data" / "raw" / "flight_operations" / "a.csv").open("a") as out:
        out.write("2025-03-01,UA\n")
    for _ in range(2):
        IngestJob(lake).ingest(flights_spec(tmp_path))
    assert [r["batch_id"] for r in lake.read(REJECTED).collect()] == ["batch_1"]
    assert lake.read(RAW).count() == 1


def test_failure_leaves_both_tables_as_they_were(spark, lake, tmp_path, monkeypatch):
    write_flights(tmp_path, [flight(), flight(flight_number="2", taxi_in="abc")])
    job, spec = IngestJob(lake), flights_spec(tmp_path)
    job.ingest(spec, batch_id="b1")
    before = content(lake, RAW), content(lake, REJECTED)
    write_flights(tmp_path, [flight(), flight(flight_number="3", taxi_in="xyz"), flight(flight_number="4")])
    real = LakeTable.publish

    def fail_at_the_second_table(self, *args):
        if self.definition.name == RAW:
            raise RuntimeError("disk on fire")
        return real(self, *args)

    monkeypatch.setattr(LakeTable, "publish", fail_at_the_second_table)
    for batch in ("b2", "b1"):
        with pytest.raises(RuntimeError, match="disk on fire"):
            job.ingest(spec, batch_id=batch)
        assert (content(lake, RAW), content(lake, REJECTED)) == before
    failed = AuditLog(spark, lake.root).read().filter("status = 'FAILED'").collect()
    assert {r["error_message"] for r in failed} == {"disk on fire"}
    assert sorted(json.loads(r["details"])["restored_rejected_rows"] for r in failed) == [0, 1]
    assert not list((tmp_path / "lake" / "_staging").glob("*"))


def test_a_failing_source_touches_no_table(lake, tmp_path):
    write_flights(tmp_path, [flight()])
    job, spec = IngestJob(lake), flights_spec(tmp_path)
    job.ingest(spec, batch_id="b1")
    before = content(lake, RAW)

    def broken(schema):
        texts, fresh = scan(lake.spark, spec, schema)
        return texts.withColumn("taxi_in", F.raise_error(F.lit("unreadable")).cast("string")), fresh

    with pytest.raises(Exception, match="unreadable"):
        job.ingest(spec, batch_id="b1", scanned=broken)
    assert content(lake, RAW) == before


def test_a_batch_that_shrinks_loses_its_other_partitions(lake, tmp_path):
    """Also a batch of which nothing is left; other batches keep their files."""
    march, april = flight(), flight(flight_number="2", flight_date="2025-04-02")
    job, spec = IngestJob(lake), flights_spec(tmp_path)
    write_flights(tmp_path, [march, april])
    job.ingest(spec, batch_id="b1")
    job.ingest(spec, batch_id="b2")
    files = {f.name for f in (tmp_path / "lake" / "bronze" / "flight_operations_raw" / "batch_id=b2").rglob("*.parquet")}
    write_flights(tmp_path, [april])
    again = job.ingest(spec, batch_id="b1")
    assert (again["rows_written"], again["rows_removed"]) == (1, 2)
    assert lake.read(RAW).groupBy("batch_id").count().orderBy("batch_id").collect() == [("b1", 1), ("b2", 2)]
    write_flights(tmp_path, [flight(taxi_in="abc")])
    gone = job.ingest(spec, batch_id="b1")
    assert (gone["rows_written"], gone["rows_removed"], gone["rows_rescued"]) == (0, 1, 1)
    assert [r[0] for r in lake.read(RAW).select("batch_id").distinct().collect()] == ["b2"]
    kept = {f.name for f in (tmp_path / "lake" / "bronze" / "flight_operations_raw" / "batch_id=b2").rglob("*.parquet")}
    assert kept == files


def test_cleaned_table_survives_a_failing_rebuild(spark, lake, feed_root):
    IngestJob(lake).run(feed_catalogue(str(feed_root), "jsonl")[:1])
    job = RefineJob(lake)
    job.run()
    before = content(lake, "silver.flight_operations_clean")
    broken = jobs._Step(lambda: lake.read(RAW).select("no_such_column"))
    with pytest.raises(Exception, match="no_such_column"):
        job._write({"silver.flight_operations_clean": broken}, "r")
    assert content(lake, "silver.flight_operations_clean") == before
    last = AuditLog(spark, lake.root).read().filter("status = 'FAILED'").first()
    assert last["target_table"] == "silver.flight_operations_clean"


def test_schema_grows(lake, tmp_path):
    job, spec = IngestJob(lake), flights_spec(tmp_path)
    write_flights(tmp_path, [flight()])
    job.ingest(spec, batch_id="b1")
    write_flights(tmp_path, [flight(flight_number="2", gate="A1")])
    assert job.ingest(spec, batch_id="b2")["evolved_columns"] == ["gate"]
    got = {r["flight_number"]: r["gate"] for r in lake.read(RAW).collect()}
    assert got == {"1": None, "2": "A1"}
    write_flights(tmp_path, [flight(flight_number="3", gate="B2", crew="7")])
    assert job.ingest(spec, batch_id="b3")["evolved_columns"] == ["crew"]
    assert lake.read(RAW).columns[-2:] == ["gate", "crew"]


def test_batches_are_pruned_as_partitions(lake, tmp_path):
    write_flights(tmp_path, [flight(), {**flight(flight_number="2"), "batch_id": "other"}])
    IngestJob(lake).ingest(flights_spec(tmp_path))
    df = lake.table(RAW).read(F.col("batch_id").isin("other") & (F.col("year_month") == "2025-03"))
    assert [r["flight_number"] for r in df.collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert len(df.inputFiles()) >= 1


def test_lineage_set_by_the_load(lake, tmp_path):
    write_flights(tmp_path, [flight()])
    spec = flights_spec(tmp_path)
    spec = spec.__class__(**{**spec.__dict__, "overwrite_metadata": True})
    IngestJob(lake, now=F.lit("2030-01-01").cast("timestamp")).ingest(spec, run_id="run-7")
    row = lake.read(RAW).first()
    assert (row["source_system"], row["source_file_name"], row["batch_id"]) == (spec.source_system, "a.csv", "run-7")
    assert str(row["ingestion_timestamp"]).startswith("2030-01-01")


# ---- single batches ------------------------------------------------------------------------

CLEAN, QUARANTINE, ROUTES = (
    f"silver.{t}" for t in ("flight_operations_clean", "flight_operations_quarantine", "route_reference")
)


def refined(lake):
    keys = ("flight_operation_key", "quarantine_key", "route_key", "weather_key")
    return [content(lake, t, *keys) for t in (CLEAN, QUARANTINE, ROUTES, "state.route_months")]


def reported(lake):
    return [content(lake, t, "load_timestamp") for t in gold.REPORTS] + [content(lake, "state.on_time_daily")]


def deliver(lake, tmp_path, batch, *rows):
    write_flights(tmp_path, list(rows))
    IngestJob(lake).ingest(flights_spec(tmp_path), batch_id=batch)


def later(hours, **changes):
    return flight(ingestion_timestamp=f"2025-05-01 {hours:02d}:00:00", **changes)


def test_single_batches_give_what_a_full_run_gives(spark, lake, tmp_path, empty_lake):
    """New months, restated and withdrawn rows, rows that turn bad, a batch that loses all its rows."""
    shutil.copytree(empty_lake, tmp_path / "full")
    full = Lake(spark, str(tmp_path / "full"))
    april = {"flight_date": "2025-04-02"}
    history = [
        ("b1", [later(1), later(1, flight_number="2"), later(1, flight_number="3", **april)]),
        ("b2", [later(2, flight_number="4", **april), later(2, flight_number="5", dest_airport="")]),
        # Restates all that b1 said of March; one of them no longer passes the rules.
        ("b3", [later(3, arr_delay_minutes="40"), later(3, flight_number="2", dest_airport="")]),
        # b1 comes again without its April flight, b2 moves to another month.
        ("b1", [later(1), later(1, flight_number="2")]),
        ("b2", [later(2, flight_number="4", flight_date="2025-06-01")]),
    ]
    months = set()
    for step, (batch, rows) in enumerate(history):
        for target in (lake, full):
            deliver(target, tmp_path, batch, *rows)
        months |= RefineJob(lake).touched_months([batch])
        RefineJob(lake).run(batches=[batch])
        if step not in (2, 4):
            continue
        RefineJob(full).run()
        assert refined(lake) == refined(full)
        ReportJob(lake).run(months=months)
        ReportJob(full).run()
        assert reported(lake) == reported(full)
        months = set()
    owners = {(r["batch_id"], r["flight_number"]) for r in lake.read(CLEAN).collect()}
    assert owners == {("b3", "1"), ("b1", "2"), ("b2", "4")}
    keys = [r[0] for r in lake.read(CLEAN).select("flight_operation_key").collect()]
    assert len(keys) == len(set(keys)) and None not in keys
    monthly = ReportJob(lake).monthly_punctuality().collect()
    assert {(r["year_month"], r["total_flights"]) for r in monthly} == {("2025-03", 2), ("2025-06", 1)}


def test_single_batches_read_and_write_only_what_they_touch(lake, tmp_path):
    deliver(lake, tmp_path, "b1", later(1), later(1, flight_number="2", flight_date="2025-04-02"))
    job = RefineJob(lake)
    job.run()
    folder = tmp_path / "lake" / "silver" / "flight_operations_clean"
    march = sorted(f.name for f in (folder / "year_month=2025-03").glob("*.parquet"))
    deliver(lake, tmp_path, "b2", later(2, flight_number="3", flight_date="2025-04-03"))
    assert job.touched_months(["b2"]) == {"2025-04"}
    raw = job.raw_flights({"2025-04"})
    assert raw.count() == 2 and all("year_month=2025-04" in f for f in raw.inputFiles()) is False
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "year_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    job.run(batches=["b2"])
    assert sorted(f.name for f in (folder / "year_month=2025-03").glob("*.parquet")) == march
    assert lake.read(CLEAN).count() == 3
    job.run(batches=["nothing"])
    assert lake.read(CLEAN).count() == 3


def test_failed_gates_publish_nothing(spark, lake, tmp_path, monkeypatch):
    deliver(lake, tmp_path, "b1", later(1), later(1, flight_number="2", dest_airport=""))
    RefineJob(lake, gated=True).run()
    ReportJob(lake, gated=True).run()
    before = refined(lake), reported(lake)
    deliver(lake, tmp_path, "b2", later(2, flight_number="3"), later(2, flight_number="4"))
    sound = silver.clean_flights
    backwards = {"scheduled_arrival_ts": F.lit("2000-01-01").cast("timestamp")}
    monkeypatch.setattr(silver, "clean_flights", lambda judged: sound(judged).withColumns(backwards))
    with pytest.raises(checks.CheckFailed, match="invalid_scheduled_sequence"):
        RefineJob(lake, gated=True).run()
    assert refined(lake) == before[0]
    monkeypatch.setattr(silver, "clean_flights", sound)
    RefineJob(lake, gated=True).run()
    whole = gold.cancellations
    monkeypatch.setattr(gold, "cancellations", lambda flights, now=None: whole(flights.withColumn("cancelled_flag", F.lit(True)), now))
    with pytest.raises(checks.CheckFailed, match="flights in cancellation_summary"):
        ReportJob(lake, gated=True).run()
    assert reported(lake) == before[1]
    log = AuditLog(spark, lake.root).read().filter("status = 'FAILED'").collect()
    assert [r["stage_name"] for r in log] == ["gate", "gate"]
    assert not list((tmp_path / "lake" / "_staging").glob("*"))


def test_each_table_is_scanned_once_by_the_checks(lake, tmp_path):
    deliver(lake, tmp_path, "b1", later(1))
    RefineJob(lake).run()
    ReportJob(lake).run()
    report = checks.run_checks(lake)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for name in (n for n in TABLES if not n.startswith("state.")):
        place = name.replace(".", "/")
        # Airports are counted and, as distinct codes, looked up for both ends of a flight.
        assert len(set(re.findall(rf"FileScan parquet \[[^\]]*\][^\n]*{place}[,\]]", plan))) <= (3 if "airports_clean" in name else 1), name
    got = {(r["check"], r["observed"], r["status"]) for r in report.collect()}
    assert ("rows of flight_operations_clean", 1, "INFO") in got and ("gold_route_rows", 1, "PASS") in got


def test_overwrite_and_no_capture(lake, tmp_path):
    write_flights(tmp_path, [flight(), flight(flight_number="2", taxi_in="abc")])
    spec = flights_spec(tmp_path)
    IngestJob(lake).ingest(spec, batch_id="b1")
    loose = spec.__class__(**{**spec.__dict__, "write_mode": "overwrite", "capture_rescued": False})
    result = IngestJob(lake).ingest(loose, batch_id="b2")
    assert (result["rows_written"], result["rows_removed"], result["rows_rescued"]) == (2, 1, 0)
    assert lake.read(RAW).filter("taxi_in is null").count() == 1


def test_missing_tables(spark, tmp_path):
    empty = Lake(spark, str(tmp_path / "nothing"))
    assert not empty.table(RAW).exists()
    write_flights(tmp_path, [flight()])
    with pytest.raises(ValueError, match="create the tables first"):
        IngestJob(empty).ingest(flights_spec(tmp_path))
    assert AuditLog(spark, empty.root).read() is None


def test_files_that_arrive_are_loaded_once(spark, lake, tmp_path):
    job, spec = IngestJob(lake), flights_spec(tmp_path, "jsonl")
    folder = tmp_path / "data" / "raw_json" / "flight_operations"

    def catch_up():
        ingest_stream(job, spec, str(tmp_path / "checkpoint")).awaitTermination()
        return lake.read(RAW).count(), lake.read(REJECTED).count()

    write_json(folder, "a.jsonl", FLIGHTS[:5])
    assert catch_up() == (5, 0)
    write_json(folder, "b.jsonl", [*FLIGHTS[5:], flight(taxi_in="abc"), flight(gate="A1")])
    assert catch_up() == (9, 1)
    assert catch_up() == (9, 1)
    assert "gate" in lake.read(RAW).columns
    assert lake.read(RAW).select("batch_id").distinct().count() == 2
    assert {r[0] for r in lake.read(RAW).select(F.col("source_system")).distinct().collect()} == {"sample_ops"}


def test_a_failing_rollback_is_logged_and_keeps_the_first_error(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path))
    log.create()

    def undo():
        raise OSError("storage is away")

    with pytest.raises(ValueError, match="bad rows"), log.stage(undo=undo):
        raise ValueError("bad rows")
    failed = log.read().filter("status = 'FAILED'").collect()
    assert len(failed) == 1
    assert "bad rows" in failed[0].error_message and "storage is away" in failed[0].error_message
