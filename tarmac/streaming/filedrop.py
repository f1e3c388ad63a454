"""Load files as they arrive: the bronze job applied to each micro-batch of a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans.jobs import IngestJob
from tarmac.sources.feeds import (
    FeedSpec,
    csv_header,
    json_lines,
    json_new_keys,
    normalize_format,
    parse_json_lines,
    scan_csv,
)


def ingest_stream(
    job: IngestJob, spec: FeedSpec, checkpoint: str, *, batch_prefix: str | None = None
) -> StreamingQuery:
    """Start loading the files of ``spec`` that were not loaded before; stops when done.

    Each micro-batch is one batch, named after its number. A micro-batch that is repeated after
    a failure replaces what it wrote, so every file counts once. ``checkpoint`` is a folder all
    executors share.
    """
    prefix = batch_prefix or spec.name
    spark = job.spark
    is_csv = normalize_format(spec.source_format) == "csv"
    if is_csv:
        header = csv_header(spark, spec)
        source = scan_csv(spark.readStream, spec, header)
    else:
        source = json_lines(spark.readStream, spec)

    def load(rows: DataFrame, number: int) -> None:
        def scanned(schema: T.StructType) -> tuple[DataFrame, list[str]]:
            known, grows = schema.fieldNames(), spec.allow_schema_evolution
            if is_csv:
                return rows, [n for n in header if grows and n not in known]
            fresh = json_new_keys(rows, known) if grows else []
            return parse_json_lines(rows, [*known, *fresh], spec.options), fresh

        job.ingest(spec, batch_id=f"{prefix}-{number:08d}", scanned=scanned)

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
