"""Source feeds: what to read, and reading every field as text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tarmac.functions.codes import blank_to_null
from tarmac.operators.align import quoted
from tarmac.operators.lineage import scanned_file_name
from tarmac.schemas import rejected_name

# Helper columns of a scan, next to the fields of the feed.
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
UNKNOWN = "_unknown_fields"
HELPERS = (CORRUPT, SOURCE_FILE, UNKNOWN)

RESCUED_COLUMN = "_rescued_data"

Reader = DataFrameReader | DataStreamReader


@dataclass(frozen=True)
class FeedSpec:
    """A directory of CSV or JSON Lines files that feeds one raw table."""

    name: str
    source_path: str
    source_format: str
    target_table: str
    source_system: str
    source_file_extension: str
    write_mode: str = "append"
    options: dict[str, str] = field(default_factory=dict)
    allow_schema_evolution: bool = True
    rejected_table: str | None = None
    rescued_column: str = RESCUED_COLUMN
    capture_rescued: bool = True
    # Lineage columns are set by the load, whatever the feed says.
    overwrite_metadata: bool = False


def normalize_format(source_format: str) -> str:
    """``csv`` or ``json``; ``jsonl`` is another name of ``json``."""
    known = {"csv": "csv", "json": "json", "jsonl": "json"}
    found = known.get(source_format.strip().lower())
    if found is None:
        raise ValueError(f"no reader for feeds in the format {source_format!r}")
    return found


# The four feeds (folder, source system).
FEEDS = {
    "flight_operations": "synthetic_airline_ops",
    "airports": "synthetic_airports",
    "aircraft_reference": "synthetic_aircraft",
    "weather_metar": "synthetic_metar",
}
TARGETS = {feed: f"bronze.{feed}_raw" for feed in FEEDS}
# Folder below the data root and file extension per format.
LAYOUT = {"csv": ("data/raw", ".csv"), "jsonl": ("data/raw_json", ".jsonl")}


def feed_spec(data_root: str, feed: str, source_format: str) -> FeedSpec:
    folder, extension = LAYOUT[source_format]
    target = TARGETS[feed]
    return FeedSpec(
        name=f"{feed}_raw",
        source_path=f"{data_root.rstrip('/')}/{folder}/{feed}",
        source_format=source_format,
        target_table=target,
        source_system=FEEDS[feed],
        source_file_extension=extension,
        options={"header": "true"} if source_format == "csv" else {},
        rejected_table=rejected_name(target),
    )


def feed_catalogue(data_root: str, variant: str = "mixed") -> list[FeedSpec]:
    """Specs of all feeds: ``csv``, ``jsonl``, or ``mixed`` (CSV, but weather as JSON Lines)."""
    formats = {
        "csv": dict.fromkeys(FEEDS, "csv"),
        "jsonl": dict.fromkeys(FEEDS, "jsonl"),
        "mixed": {**dict.fromkeys(FEEDS, "csv"), "weather_metar": "jsonl"},
    }
    if variant not in formats:
        raise ValueError(f"no catalogue of feeds is called {variant!r}")
    return [feed_spec(data_root, feed, fmt) for feed, fmt in formats[variant].items()]


# ---- scanning ------------------------------------------------------------------------------


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def _texts(df: DataFrame, names: list[str]) -> DataFrame:
    """Blank text is no value, in either format."""
    return df.select(*[blank_to_null(quoted(n)).alias(n) for n in names], *HELPERS)


def csv_options(spec: FeedSpec) -> dict[str, str]:
    """Reader options: quotes are escaped by doubling; header names are checked per file.

    Column pruning stays off in the parser: with it, a line with too few or too many values
    looks sound to a query that needs only some of the columns.
    """
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        **spec.options,
        "inferSchema": "false",
        "enforceSchema": "false",
        "columnPruning": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def csv_header(spark: SparkSession, spec: FeedSpec) -> list[str]:
    """Column names from the header line (no pass over the data)."""
    return spark.read.options(**csv_options(spec)).csv(spec.source_path).columns


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a partition; the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def first_lines(spark: SparkSession, path: str) -> dict[str, str]:
    """The first line of every file below ``path``: one job with a task per file, which stops after that line.

    What comes to the driver is a line per file, as its listing does.
    """
    whole = str(1 << 60)
    sizes = {"spark.sql.files.maxPartitionBytes": whole, "spark.sql.files.openCostInBytes": whole}
    before = {key: spark.conf.get(key) for key in sizes}
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    try:
        for key, value in sizes.items():  # a file is one partition
            spark.conf.set(key, value)
        found = lines.mapInArrow(_first_rows, lines.schema).collect()
        return {unquote(r["file"]): r["value"] for r in found}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def csv_headers(spark: SparkSession, spec: FeedSpec) -> dict[tuple[str, ...], list[str]]:
    """The feed's files by the column names of their header lines."""
    files: dict[str, list[str]] = {}
    for path, line in sorted(first_lines(spark, spec.source_path).items()):
        files.setdefault(line, []).append(path)
    groups: dict[tuple[str, ...], list[str]] = {}
    for paths in files.values():
        names = spark.read.options(**csv_options(spec)).csv(paths[0]).columns
        groups.setdefault(tuple(names), []).extend(paths)
    return groups


def scan_csv_files(spark: SparkSession, spec: FeedSpec) -> tuple[DataFrame, list[str]]:
    """All files of the feed, one scan per distinct header, matched by column name; and the names of all columns.

    Columns that a file does not have are NULL in its rows. Order of columns: as they come up over the files by name.
    """
    groups = csv_headers(spark, spec)
    if len(groups) < 2:
        names = list(next(iter(groups))) if groups else csv_header(spark, spec)
        return scan_csv(spark.read, spec, names), names
    names = list(dict.fromkeys(n for header in groups for n in header))
    scans = [scan_csv(spark.read, spec, list(header), paths) for header, paths in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans), names


def scan_csv(
    reader: Reader, spec: FeedSpec, names: list[str], paths: list[str] | None = None
) -> DataFrame:
    lines = reader.options(**csv_options(spec)).schema(_text_schema(names)).csv(paths or spec.source_path)
    nothing = F.lit(None).cast("map<string,string>")
    return _texts(
        lines.select("*", scanned_file_name().alias(SOURCE_FILE), nothing.alias(UNKNOWN)), names
    )


def json_lines(reader: Reader, spec: FeedSpec) -> DataFrame:
    """One row per non-blank line, with the name of its file."""
    lines = reader.options(**spec.options).text(spec.source_path)
    return lines.select("value", scanned_file_name().alias(SOURCE_FILE)).filter(
        F.trim("value") != ""
    )


def parsed_lines(lines: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Each line parsed once, into a map from its top-level keys to texts (nested values as JSON text).

    The map is NULL for a line that is not a JSON object. Of a key given twice the first value counts.
    """
    settings = {**(options or {}), "mode": "PERMISSIVE"}
    found = F.from_json("value", T.MapType(T.StringType(), T.StringType()), settings)
    return lines.select(found.alias("found"), "value", SOURCE_FILE)


# New columns that one load may bring; the names come to the driver, as a schema does.
MOST_NEW_COLUMNS = 1000


def json_new_keys(lines: DataFrame, declared: list[str]) -> list[str]:
    """Top-level keys beyond the declared ones; the distinct runs map-side first.

    A feed with more than ``MOST_NEW_COLUMNS`` of them fails: its keys are data, not columns.
    """
    keys = lines.select(F.explode(F.json_object_keys("value")).alias("key"))
    fresh = keys.filter(~F.col("key").isin(declared)).distinct().limit(MOST_NEW_COLUMNS + 1)
    names = sorted(row["key"] for row in fresh.collect())
    if len(names) > MOST_NEW_COLUMNS:
        raise ValueError(f"more than {MOST_NEW_COLUMNS} new keys; load this feed without schema growth")
    return names


def parse_json_lines(
    lines: DataFrame, names: list[str], options: dict[str, str] | None = None
) -> DataFrame:
    """The named keys as text, other keys in a map, from one parse of each line."""
    parsed = parsed_lines(lines, options)
    found = F.col("found")
    others = F.map_filter(found, lambda key, value: ~key.isin(names) & value.isNotNull())
    rows = parsed.select(
        *[F.try_element_at(found, F.lit(n)).alias(n) for n in names],
        F.when(found.isNull(), F.col("value")).alias(CORRUPT),
        F.when(F.size(others) > 0, others).alias(UNKNOWN),
        SOURCE_FILE,
    )
    return _texts(rows, names)


def scan(
    spark: SparkSession, spec: FeedSpec, declared: T.StructType
) -> tuple[DataFrame, list[str]]:
    """Every field of the feed as text plus the helper columns, and the names of new fields.

    New fields become columns only if the spec allows the schema to grow.
    """
    known = declared.fieldNames()
    if normalize_format(spec.source_format) == "csv":
        rows, names = scan_csv_files(spark, spec)
        fresh = [n for n in names if n not in known]
        return rows, fresh if spec.allow_schema_evolution else []
    lines = json_lines(spark.read, spec)
    fresh = json_new_keys(lines, known) if spec.allow_schema_evolution else []
    return parse_json_lines(lines, [*known, *fresh], spec.options), fresh
