"""Session settings that the results or the run time depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Epoch dates fall on days of the session time zone.
# The method limit keeps generated methods below the size that the JVM compiles: the wide
# projections here would otherwise run interpreted.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder, time_zone: str = "UTC") -> SparkSession.Builder:
    for key, value in {**SETTINGS, "spark.sql.session.timeZone": time_zone}.items():
        builder = builder.config(key, value)
    return builder


def local_session(master: str = "local[*]", memory: str = "16g") -> SparkSession:
    """Session on one machine, for tests and timing."""
    cpus = master.partition("[")[2].rstrip("]")
    partitions = cpus if cpus.isdigit() else "8"
    builder = configure(SparkSession.builder.master(master))
    spark = (
        builder.config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
