"""Session settings the library relies on (used by tests and the bench).

On a cluster the session comes from the platform; only the runtime
settings below matter, and :func:`configure` sets them on an existing one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Timestamps print and hash in UTC, so digests do not depend on where a job runs.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: broadcast a join side only once its measured size is
    # small, split skewed partitions of a join, coalesce small shuffle outputs.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs a shuffle afterwards.
    # The own-key check leaves its output partitioned for the merge, and
    # without this AQE would keep, say, all NULL-key rows in one task to save
    # that shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "refinery") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
