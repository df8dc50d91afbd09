"""Counts that show whether rows went missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import constants as C
from ..functions import is_blank


def key_range(df: DataFrame, key: str, by: list[str] | None = None, empty: int | None = None):
    """Lowest and highest key, per ``by`` if given; ``empty`` replaces NULL."""
    low, high = F.min(key), F.max(key)
    if empty is not None:
        low, high = F.coalesce(low, F.lit(empty)), F.coalesce(high, F.lit(empty))
    return df.groupBy(*(by or [])).agg(low.alias("min_key"), high.alias("max_key"))


def rows_per_file(stage: DataFrame, files: DataFrame) -> DataFrame:
    """``files`` (batch_id, file_name, ...) with ``rows_inserted``, 0 where Stage has none."""
    counts = stage.groupBy("batch_id", F.col("_source_file").alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows_inserted")
    )
    joined = files.join(counts, ["batch_id", "file_name"], "left")
    return joined.withColumn("rows_inserted", F.coalesce("rows_inserted", F.lit(0)))


def file_audit(files: DataFrame, stage: DataFrame) -> DataFrame:
    """Per file rows loaded, rows inserted and the difference (NULL if either is unknown)."""
    return rows_per_file(stage, files).select(
        "batch_id",
        "file_name",
        "rows_loaded",
        "rows_inserted",
        (F.col("rows_loaded") - F.col("rows_inserted")).alias("diff"),
    )


def conservation(stage: DataFrame, valid: DataFrame, invalid: DataFrame) -> DataFrame:
    """Per batch: Stage rows against the rows of both branches, in one aggregate."""

    def tagged(df, name):
        return df.select("batch_id", *[F.lit(int(n == name)).alias(n) for n in parts])

    parts = ["stage_rows", "valid_rows", "invalid_rows"]
    tables = [tagged(df, n) for df, n in zip((stage, valid, invalid), parts)]
    sums = [F.sum(n).cast("bigint").alias(n) for n in parts]
    counted = reduce(DataFrame.unionByName, tables).groupBy("batch_id").agg(*sums)
    missing = F.col("stage_rows") - F.col("valid_rows") - F.col("invalid_rows")
    return counted.withColumn("missing_rows", missing)


def routed(stage: DataFrame) -> DataFrame:
    """What ``conservation`` gives for both branches of Stage, from one scan of Stage."""
    valid = (F.col("is_valid") == 1) & ~is_blank(F.col("patent_id"))
    counted = stage.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("stage_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(F.col("is_valid") == 0).alias("invalid_rows"),
    )
    missing = F.col("stage_rows") - F.col("valid_rows") - F.col("invalid_rows")
    return counted.withColumn("missing_rows", missing)


def run_totals(log: DataFrame) -> DataFrame:
    """Files and rows of all runs in a file log, per batch."""
    return log.groupBy("batch_id").agg(
        F.count(F.when(F.col("status") == C.STATUS_OK, 1)).alias("files_ok"),
        F.count(F.when(F.col("status") == C.STATUS_FAILED, 1)).alias("files_failed"),
        F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
    )


def repeated_lookup_keys(lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Dictionary keys that occur more than once and so would multiply rows."""
    return lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
