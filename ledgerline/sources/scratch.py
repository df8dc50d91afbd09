"""Folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerline-")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named in ``spark.checkpoint.dir``.

    Only in a local session without that setting a temporary folder takes its place; executors of
    a cluster could not reach it, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master!r}")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, and the rows
    stay the same for every later reader, also after lost executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
