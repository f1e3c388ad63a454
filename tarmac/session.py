"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    # Clock strings become timestamps in the session zone; results must not
    # depend on where the driver happens to run.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys and hot partitions of a rebalance are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles methods beyond 8000 bytes of bytecode. The wide flight projections
    # exceed that when fused into one method; split functions run about twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tarmac", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``master`` stays unset on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
