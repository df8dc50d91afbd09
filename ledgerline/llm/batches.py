"""Bounds on what a Python worker holds at a time."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS = 1000
KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(spark: SparkSession, rows: int = ROWS) -> None:
    """Send texts to Python in batches of at most ``rows`` rows; a smaller setting stays."""
    now = int(spark.conf.get(KEY))
    if now <= 0 or now > rows:
        spark.conf.set(KEY, str(rows))
