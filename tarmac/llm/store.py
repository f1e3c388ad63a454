"""Intermediate tables in the shared folder, connected components, and session settings."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Documents per Arrow batch: bounds what a Python worker holds at once.
BATCH_ROWS = "512"
# Wide rows that a reader or writer holds at once, and the bytes of them that go to a Python worker at once.
WIDE_ROWS, WIDE_BYTES = 2, 8 << 20

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:
    _libc = None

_own: dict[str, str] = {}
_made: list[tuple[SparkSession, str]] = []


def setup(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and adaptive execution, which splits hot join keys."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Shuffle files go as soon as the table they were made for is written.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def trim() -> None:
    """Give freed memory back to the system: reused Python workers otherwise keep the peak of every step."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where unset and the master is one local JVM."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = tempfile.mkdtemp(prefix="tarmac-")
    return _own[key]


def keep(df: DataFrame, *partition_by: str, wide: bool = False) -> DataFrame:
    """Write the rows to the shared folder and read them again: cuts lineage, survives lost executors.

    ``wide`` is for rows of megabytes: they are written out, and later read, a few at a time. Parquet otherwise gathers a hundred rows before
    it first looks at their size, and a reader's batch takes all rows of a group.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tarmac-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    writer = df.write.option("compression", "zstd")
    if wide:
        writer = writer.option("parquet.block.row.count.limit", WIDE_ROWS)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete kept tables that nothing needs any more."""
    for table in tables:
        folders = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in table.inputFiles()}
        for entry in [x for x in _made if x[1].rsplit("/", 1)[1] in folders]:
            _delete(*entry)
            _made.remove(entry)


def mark() -> int:
    """How many tables are kept now, for ``release_since``."""
    return len(_made)


def release_since(made: int, *but: DataFrame) -> None:
    """Delete the tables kept since ``made`` was marked, except those given."""
    stay = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for table in but for f in table.inputFiles()}
    for entry in [x for x in _made[made:] if x[1].rsplit("/", 1)[1] not in stay]:
        _delete(*entry)
        _made.remove(entry)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _clean() -> None:
    for spark, path in _made:
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (node, root), one root per component.

    Each round maps every node to the neighbour of lowest scrambled id and contracts the graph, so the
    number of rounds grows with the logarithm of the component size. Only aggregates and joins on
    freshly read tables are used, so a node with very many links is pre-aggregated or split.
    """
    edges = keep(links.select("a", "b").where("a <> b").distinct())
    maps = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        best = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id")))
        own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("id"))
        step = both.groupBy(F.col("a").alias("node")).agg(best.alias("m"))
        step = keep(step.select("node", F.least("m", own).getField("id").alias("root")))
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(left, "a").select("b", "ra").join(right, "b")
        edges = keep(
            moved.select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct()
        )
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    total = maps.pop()
    while maps:
        later = total.select(F.col("node").alias("root"), F.col("root").alias("top"))
        total = keep(
            maps.pop()
            .join(later, "root", "left")
            .select("node", F.coalesce("top", "root").alias("root"))
        )
    return total
