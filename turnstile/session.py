"""Session helpers."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs rely on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose build side turns out small per partition skip the sort of the large side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("turnstile")
    defaults = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        # Short queries in one session: keep their compiled code.
        "spark.sql.codegen.cache.maxEntries": "10000",
    }
    for key, value in {**SETTINGS, **defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names; without one, a folder in the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    # Every machine of a cluster reaches the warehouse; a temporary folder only its own machine.
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    context.setCheckpointDir(configured or f"{warehouse}/_checkpoints")
