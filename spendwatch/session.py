"""Session defaults for tests and the benchmark (local mode).

On a cluster the session comes from the platform.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The size check behind every broadcast the planner chooses on its own.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Full ReadSchema / PushedFilters in explain output.
    "spark.sql.maxMetadataStringLength": "1000",
    # PySpark 4 records the Python call site of every Column function for
    # error messages (several JVM round trips per call); off for local runs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  driver_memory: str = "8g", extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("spendwatch")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
