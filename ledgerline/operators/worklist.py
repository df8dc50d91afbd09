"""What is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as C


def open_work(
    file_log: DataFrame,
    done: DataFrame,
    ods_table: str,
    stage_table: str,
    mode: str = "all_not_success",
    limit: int | None = None,
) -> DataFrame:
    """Files to bring into Stage, oldest first: file_name, batch_id, rows_loaded.

    ``new`` and ``all_not_success``: loaded files without a successful Stage run since they were
    last loaded. ``retry_failed``: files whose Stage run failed.
    """
    done = done.where((F.col("table_name") == ods_table) & (F.col("stage_table") == stage_table))
    if mode == "retry_failed":
        files = done.where(F.col("status") == C.STATUS_FAILED)
    else:
        keys = ["table_name", "batch_id", "file_name"]
        loaded = file_log.where(
            (F.col("table_name") == ods_table) & (F.col("status") == C.STATUS_OK)
        )
        finished = done.where(F.col("status") == C.STATUS_OK)
        finished = finished.select(*keys, F.col("updated_at").alias("_done_at"))
        known = [loaded[k] == finished[k] for k in keys]
        newer = loaded["updated_at"] <= finished["_done_at"]
        files = loaded.join(finished, [*known, newer], "left_anti")
    files = files.orderBy("updated_at", "file_name")
    if limit is not None:
        files = files.limit(limit)
    return files.select("file_name", "batch_id", "rows_loaded")


def first_candidates(
    stage: DataFrame, column: str, marks: tuple[str, ...], limit: int, key: str = "stage_id"
) -> DataFrame:
    """The first valid rows by key whose ``column`` holds one of the marks (a top-n report)."""
    has_mark = F.lit(False)
    for mark in marks:
        has_mark = has_mark | F.contains(F.col(column), F.lit(mark))
    return (
        stage.where((F.col("is_valid") == 1) & has_mark)
        .select(key, column)
        .orderBy(key)
        .limit(limit)
    )
