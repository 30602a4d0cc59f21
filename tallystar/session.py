"""Session settings that the plans in this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings; each can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the aggregate above it then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Elapsed times on timestamps without a zone must not depend on daylight saving.
    "spark.sql.session.timeZone": "UTC",
    # Rows that pass a Python worker travel in batches that long texts cannot swell.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def is_local(spark: SparkSession) -> bool:
    """Whether the driver is the only process, so that its files and memory are visible to all tasks."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app_name: str = "tallystar", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
