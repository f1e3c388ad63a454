"""Run log: one row per STARTED, SUCCESS or FAILED event."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import AUDIT
from tarmac.sinks.lake import path_missing

DEFAULT_AUDIT_TABLE = AUDIT.name


class AuditLog:
    def __init__(self, spark: SparkSession, root: str, table: str = DEFAULT_AUDIT_TABLE):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{table.replace('.', '/')}"

    def create(self) -> None:
        if self.read() is None:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in AUDIT.schema]
            self.spark.range(0).select(nothing).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame | None:
        """All events, or None when there is no audit table."""
        try:
            return self.spark.read.schema(AUDIT.schema).parquet(self.path)
        except AnalysisException as error:
            if path_missing(error):
                return None
            raise

    def log(self, *, details: dict[str, Any] | None = None, **fields: Any) -> None:
        """Append one event; silently nothing when there is no audit table."""
        if self.read() is None:
            return
        event = {
            **fields,
            "event_timestamp": datetime.now(timezone.utc).replace(microsecond=0),
            "details": json.dumps(details, sort_keys=True) if details else None,
        }
        unknown = set(event) - set(AUDIT.schema.fieldNames())
        if unknown:
            raise TypeError(f"not in the run log: {sorted(unknown)}")
        one = self.spark.range(0, 1, 1, 1)
        row = one.select([F.lit(event.get(f.name)).cast(f.dataType).alias(f.name) for f in AUDIT.schema])
        row.write.mode("append").parquet(self.path)

    @contextmanager
    def stage(
        self,
        *,
        undo: Callable[[], dict[str, Any]],
        details: dict[str, Any] | None = None,
        **fields: Any,
    ) -> Iterator[dict[str, Any]]:
        """Log STARTED, then SUCCESS with what the body put into the yielded dict.

        When the body fails, ``undo`` runs, FAILED is logged with what it returns and the error
        goes on to the caller, also when ``undo`` fails.
        """
        self.log(status="STARTED", details=details, **fields)
        outcome: dict[str, Any] = {}
        try:
            yield outcome
        except Exception as error:
            failed = {**fields, "status": "FAILED", "error_message": str(error)}
            try:
                failed |= undo()
            except Exception as second:
                failed["error_message"] = f"{error}; taking it back failed as well: {second}"
            self.log(**failed)
            raise
        self.log(**{**fields, "status": "SUCCESS", **outcome})
