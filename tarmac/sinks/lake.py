"""Tables as plain parquet folders, written by partition overwrite.

    <root>/<layer>/<table>/<partition>=<value>/*.parquet
    <root>/<layer>/<table>/_columns     columns beyond the declared ones, in the order they came
    <root>/_staging/<id>                rows of a run that are not published yet

A run stages its rows first, so that a failing source or a failed check touches no table. Publishing is one Spark job that
overwrites exactly the partitions of the batches, months or days that the run stands for. Partitions that had rows before and
have none now are overwritten with a single marker row, which readers leave out; thus one job both replaces and removes.
Tables without a declared partitioning have one partition for all rows. One writer per table is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.align import quoted
from tarmac.schemas import TABLES, TableDef

SLOT = "table_slot"
REMOVED = "partition_removed"
STAGING = "_staging"


@dataclass(frozen=True)
class Staged:
    """Rows of a run that are not published yet, with the partitions they belong to."""

    path: str | None
    rows: DataFrame
    count: int
    values: tuple
    partitions: frozenset


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def one_of(column: Column, values: Collection) -> Column:
    """Whether ``column`` is among ``values``, which may hold None; prunes partitions."""
    known = [v for v in values if v is not None]
    inside = column.isin(known) if known else F.lit(False)
    return inside | column.isNull() if None in values else inside


class LakeTable:
    def __init__(self, spark: SparkSession, root: str, definition: TableDef):
        self.spark = spark
        self.root = root.rstrip("/")
        self.definition = definition
        self.path = f"{self.root}/{definition.name.replace('.', '/')}"
        self.keys = definition.partition_by or (SLOT,)
        self._known: list[tuple[str, str]] | None = None

    # ---- columns ---------------------------------------------------------------------------

    def _added(self) -> list[tuple[str, str]] | None:
        """Columns that were added, as (name, type); None when there is no such table. Read once: there is one writer."""
        if self._known is not None:
            return self._known
        try:
            lines = self.spark.read.text(f"{self.path}/_columns").collect()
        except AnalysisException as error:
            if path_missing(error):
                return None
            raise
        entries = sorted({tuple(json.loads(r["value"])) for r in lines})
        self._known = [(name, ddl) for _, name, ddl in entries]
        return self._known

    def exists(self) -> bool:
        return self._added() is not None

    def schema(self) -> T.StructType:
        added = self._added()
        if added is None:
            raise ValueError(f"There is no table {self.definition.name} yet; create the tables first.")
        fields = [T.StructField(name, T.StructType.fromDDL(f"x {ddl}")[0].dataType) for name, ddl in added]
        return T.StructType([*self.definition.schema.fields, *fields])

    def _note(self, fields: Collection[T.StructField], after: int) -> None:
        lines = [json.dumps([after + i, f.name, f.dataType.simpleString()]) for i, f in enumerate(fields)]
        text = F.array(*map(F.lit, lines)).cast("array<string>")
        rows = self.spark.range(0, 1, 1, 1).select(F.explode(text).alias("value"))
        rows.write.mode("append").text(f"{self.path}/_columns")
        self._known = None

    def create(self) -> bool:
        """Create the empty table unless it exists."""
        if self.exists():
            return False
        self._note([], 0)
        return True

    def grow(self, schema: T.StructType) -> None:
        """Add the fields of ``schema`` that the table does not have yet."""
        have = self.schema().fieldNames()
        fresh = [f for f in schema.fields if f.name not in have]
        if fresh:
            self._note(fresh, len(have))

    # ---- reading ---------------------------------------------------------------------------

    def _stored(self, schema: T.StructType) -> T.StructType:
        """The columns in the files: partition columns that are no table columns, and the marker."""
        hidden = [T.StructField(k, T.StringType()) for k in self.keys if k not in schema.fieldNames()]
        return T.StructType([*schema.fields, *hidden, T.StructField(REMOVED, T.BooleanType())])

    def _scan(self) -> DataFrame:
        return self.spark.read.schema(self._stored(self.schema())).parquet(self.path)

    def read(self, where: Column | None = None) -> DataFrame:
        """The table's rows; ``where`` may also use partition columns that are no table columns."""
        rows = self._scan().filter(F.col(REMOVED).isNull())
        rows = rows if where is None else rows.filter(where)
        return rows.select([quoted(f) for f in self.schema().fieldNames()])

    def slots_of(self, where: Column) -> set:
        """Values of the first partition column among the rows that fulfil ``where``."""
        found = self._scan().filter(F.col(REMOVED).isNull()).filter(where).select(self.keys[0]).distinct()
        return {row[0] for row in found.collect()}

    # ---- writing ---------------------------------------------------------------------------

    def stage(self, df: DataFrame, *, rebalance: bool = True, stored: bool = False) -> Staged:
        """Write ``df`` to a folder of its own, without making it visible.

        With ``rebalance`` rows are gathered by partition value first, so that a task does not
        write a small file per partition; adaptive execution splits partitions that are large. What comes
        back to the driver are the partitions written, which it has to list in any case. Rows that come
        straight from ``stored`` files are not written a second time.
        """
        if SLOT in self.keys:
            df = df.withColumn(SLOT, F.lit("all"))
        if rebalance:
            df = df.hint("rebalance", *self.keys)
        key = self.definition.key
        if key:
            # Above every key in use, so that rows in untouched partitions keep theirs.
            top = self._scan().agg(F.max(key)).first()[0] or 0
            df = df.withColumn(key, F.monotonically_increasing_id() + F.lit(top + 1))
        return self._counted(df, None) if stored else self.stage_as_is(df)

    def stage_as_is(self, df: DataFrame) -> Staged:
        """Write rows of any columns, partitioned as this table is, to a folder of their own."""
        path = f"{self.root}/{STAGING}/{uuid4().hex}"
        df.write.partitionBy(*self.keys).parquet(path)
        return self._counted(self.spark.read.schema(df.schema).parquet(path), path)

    def _counted(self, written: DataFrame, path: str | None) -> Staged:
        # Counted from what was written (file footers): retried tasks cannot distort it.
        parts = written.groupBy(*self.keys).count().collect()
        return Staged(
            path,
            written,
            sum(r["count"] for r in parts),
            tuple(sorted({r[0] for r in parts}, key=lambda v: (v is None, str(v)))),
            frozenset(tuple(r[k] for k in self.keys) for r in parts),
        )

    def publish(self, staged: Staged | None, replaced: Collection | None = ()) -> int:
        """Overwrite the partitions of ``replaced`` (values of the first partition column; None: all) and of the staged
        rows themselves; returns how many rows were there before."""
        if replaced is None:
            hit = F.lit(True)
        else:
            hit = one_of(F.col(self.keys[0]), {*replaced, *(staged.values if staged else ())})
        old = self._scan().filter(hit)
        # One row per partition, from partition values and footers alone.
        before = old.groupBy(*self.keys).agg(F.count_if(F.col(REMOVED).isNull()).alias("n")).collect()
        keep = staged.partitions if staged else frozenset()
        gone = [tuple(r[k] for k in self.keys) for r in before if r["n"]]
        gone = [p for p in gone if p not in keep]
        stored = self._stored(self.schema())
        marker = T.StructType([*[stored[k] for k in self.keys], stored[REMOVED]])
        rows = self.spark.createDataFrame([(*p, True) for p in gone], marker).coalesce(1)
        if staged and staged.count:
            rows = staged.rows.unionByName(rows, allowMissingColumns=True) if gone else staged.rows
        if gone or (staged and staged.count):
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*self.keys).parquet(self.path)
        return sum(r["n"] for r in before)

    def discard(self, staged: Staged | None) -> None:
        """Delete staged rows."""
        if staged and staged.path:
            jvm = self.spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(staged.path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Lake:
    """The declared tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._tables: dict[str, LakeTable] = {}

    def table(self, name: str) -> LakeTable:
        if name not in self._tables:
            self._tables[name] = LakeTable(self.spark, self.root, TABLES[name])
        return self._tables[name]

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def create_tables(self) -> list[str]:
        """Create every declared table that does not exist yet; returns the new ones."""
        return [name for name in TABLES if self.table(name).create()]

    def create_views(self, layer: str | None = None) -> list[str]:
        """Temporary views ``layer_table`` over the tables, for SQL users."""
        made = []
        for name, definition in TABLES.items():
            if (layer is None or definition.layer == layer) and self.table(name).exists():
                view = name.replace(".", "_")
                self.read(name).createOrReplaceTempView(view)
                made.append(view)
        return made
