"""CSV folder to raw table, with a log of files so that a run can be resumed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, functions as F

from .. import constants as C, schemas
from ..operators.upsert import delete_files
from ..params import INGEST_MODES, Params
from ..sources.csv_files import Loaded, UNDECODABLE, list_files, read_files, write_failed_list
from ..sources.tables import Tables

Item = TypeVar("Item")
RUN_ERRORS = (PySparkException, Py4JError)


def isolate_failures(
    items: Sequence[Item], run: Callable[[list[Item]], None]
) -> list[tuple[Item, str]]:
    """Run all items together; if that fails, run halves, down to the items that fail alone."""
    items = list(items)
    if not items:
        return []
    try:
        run(items)
        return []
    except RUN_ERRORS as error:
        if len(items) == 1:
            text = f"{type(error).__name__}: {error}"
            return [(items[0], text[: C.ERROR_TEXT_LENGTH])]
    middle = len(items) // 2
    return isolate_failures(items[:middle], run) + isolate_failures(items[middle:], run)


def files_to_load(
    files: DataFrame, log: DataFrame, mode: str, skip_unchanged: bool = True
) -> DataFrame:
    """Files for a run: all (``full``), new or changed ones (``resume``), or those that failed
    before and still exist, oldest first (``rerun_failed``)."""
    if mode not in INGEST_MODES:
        raise ValueError(f"mode must be one of {INGEST_MODES}, not {mode!r}")
    columns = files.columns
    if mode == "rerun_failed":
        failed = log.where(F.col("status") == C.STATUS_FAILED).select("file_path", "updated_at")
        return files.join(failed, "file_path").orderBy("updated_at").select(*columns)
    if mode == "resume" and skip_unchanged:
        keys = ["file_path", "file_size", "file_mtime"]
        loaded = log.where(F.col("status") == C.STATUS_OK)
        loaded = loaded.withColumn("file_mtime", F.date_trunc("second", "file_mtime"))
        return files.join(loaded.select(*keys), keys, "left_anti").select(*columns).orderBy("file_path")
    return files


def ingest(
    tables: Tables,
    params: Params,
    folder: str,
    mode: str = "full",
    *,
    skip_unchanged: bool = True,
    encodings: Sequence[str] = ("UTF-8",),
    replace_rows: bool | None = None,
    failed_list: str | None = None,
    files: DataFrame | None = None,
) -> str:
    """Load the CSV files of a folder, or those in ``files`` (as ``list_files`` gives them); returns the
    batch id.

    Files that cannot be read, that have undecodable characters or a quote that is never closed are
    logged as FAILED with the reason, and nothing of them lands; all others land. If any has failed,
    a list of the batch's failed files is written to ``failed_list`` (``failed_files`` beside the tables).
    Records with other than 30 fields land filled up or cut, as every short or long line does; they
    are copied to ``params.bad_records``, and the log counts them.

    ``replace_rows`` first takes out rows that an interrupted run has left of the same files; it is on
    for all modes but ``full``, which only adds. Of several encodings a file takes the first that reads
    all of its characters.
    """
    spark = tables.spark
    log = tables.read(params.file_log, schemas.FILE_LOG, only=lambda b: b == params.batch_id)
    log = log.where(F.col("table_name") == params.ods_table)
    files = list_files(spark, folder) if files is None else files
    todo = files_to_load(files, log, mode, skip_unchanged).collect()
    if not todo:
        return params.batch_id
    loaded: list[tuple[DataFrame, str, list[Row]]] = []
    bad: list[tuple[Row, str]] = []

    def load(files: list[Row], choices: Sequence[str] = tuple(encodings)) -> None:
        found: Loaded = read_files(spark, {f.file_path: f.file_size for f in files}, choices[0])
        why = found.bad_files
        # By name: a list of files would be searched for every file.
        others = {n for n, text in why.items() if len(choices) > 1 and UNDECODABLE in text}
        again = [f for f in files if f.file_name in others]
        if again:
            load(again, choices[1:])
        bad.extend((f, why[f.file_name]) for f in files if f.file_name in why and f.file_name not in others)
        good = [f for f in files if f.file_name not in why]
        if good:
            loaded.append((found.rows, choices[0], good))

    failures = isolate_failures(todo, load) + bad
    stored = None
    if loaded:
        stored = _store(tables, params, loaded, mode != "full" if replace_rows is None else replace_rows)
    _log_files(tables, params, loaded, stored, failures)
    if failures:
        log = tables.read(params.file_log, schemas.FILE_LOG, only=lambda b: b == params.batch_id)
        place = failed_list or f"{tables.path('failed_files')}/{params.batch_id}"
        write_failed_list(log.where(F.col("table_name") == params.ods_table), place)
    return params.batch_id


def _store(tables: Tables, params: Params, loaded, replace_rows: bool) -> DataFrame:
    """Write the rows; returns them as they are stored, with ``_record``."""
    rows = loaded[0][0]
    for more, _, _ in loaded[1:]:
        rows = rows.unionByName(more)
    no_user = F.lit(None).cast("string")
    rows = rows.withColumns(
        {"batch_id": F.lit(params.batch_id), "created_by": no_user, "updated_by": no_user}
    )
    names = [(params.batch_id, f.file_name) for _, _, files in loaded for f in files]
    files = tables.spark.createDataFrame(names, "batch_id string, _source_file string")
    new = tables.write(rows.select(*schemas.ODS.fieldNames(), "_record"), params.ods_table, "batch_id", odd=F.count("_record"))
    is_batch = lambda b: b == params.batch_id
    touched = tables.versions_with(params.ods_table, schemas.ODS, files, is_batch) if replace_rows else []
    schema = schemas.T.StructType([*schemas.ODS.fields, schemas.T.StructField("_record", schemas.T.StringType())])
    stored = tables.rows_of(new, schema)
    _quarantine(tables, params, stored if new.counts.get("odd") else None, files)
    if touched:
        # Only what holds rows of these files is written again.
        old = tables.read(params.ods_table, schemas.ODS, is_batch, touched)
        left = tables.write(delete_files(old, files), params.ods_table, "batch_id")
        tables.publish(left, new, old=touched)
    else:
        tables.publish(new)
    return stored


def _quarantine(tables: Tables, params: Params, rows: DataFrame | None, files: DataFrame) -> None:
    """Put copies of the odd records of these files in place of earlier ones."""
    files = files.select(
        "batch_id", F.lit(params.ods_table).alias("table_name"), F.col("_source_file").alias("file_name")
    )
    keys = ["batch_id", "table_name", "file_name"]
    old = tables.read(params.bad_records, schemas.BAD_RECORDS, only=lambda b: b == params.batch_id)
    if rows is None and old.join(files, keys, "left_semi").isEmpty():
        return
    kept = old.join(files, keys, "left_anti").select(*schemas.BAD_RECORDS.fieldNames())
    if rows is not None:
        odd = rows.where(F.col("_record").isNotNull())
        kept = kept.unionByName(odd.select(
            "batch_id", F.lit(params.ods_table).alias("table_name"), F.col("_source_file").alias("file_name"),
            F.col("_row_num").alias("row_num"), F.col("_record").alias("record"),
        ))
    version = tables.write(kept, params.bad_records, "batch_id")
    tables.publish(version, gone=lambda b: b == params.batch_id)


def _log_files(tables: Tables, params: Params, loaded, stored: DataFrame | None, failures) -> None:
    spark = tables.spark
    file_type = "file_path string, file_name string, file_size long, file_mtime timestamp"
    entries = []
    if loaded:
        counts = stored.groupBy(F.col("_source_file").alias("file_name")).agg(
            F.count(F.lit(1)).alias("rows_loaded"), F.count("_record").alias("odd")
        )
    for _, encoding, files in loaded:
        listed = spark.createDataFrame(files, file_type)
        entries.append(
            listed.join(counts, "file_name", "left").withColumns(
                {
                    "rows_loaded": F.coalesce("rows_loaded", F.lit(0)).cast("bigint"),
                    "status": F.lit(C.STATUS_OK),
                    "encoding": F.lit(encoding),
                    "error_message": F.when(F.col("odd") > 0, F.concat("odd", F.lit(f" records {C.ODD_RECORDS}"))),
                }
            ).drop("odd")
        )
    if failures:
        failed = [(*file, text) for file, text in failures]
        listed = spark.createDataFrame(failed, file_type + ", error_message string")
        entries.append(
            listed.withColumns(
                {
                    "rows_loaded": F.lit(None).cast("bigint"),
                    "status": F.lit(C.STATUS_FAILED),
                    "encoding": F.lit(None).cast("string"),
                }
            )
        )
    log = entries[0]
    for more in entries[1:]:
        log = log.unionByName(more)
    log = log.withColumns(
        {
            "batch_id": F.lit(params.batch_id),
            "table_name": F.lit(params.ods_table),
            "created_at": F.lit(params.run_ts),
            "updated_at": F.lit(params.run_ts),
        }
    ).select(*schemas.FILE_LOG.fieldNames())
    tables.upsert(log, params.file_log, schemas.FILE_LOG, schemas.FILE_LOG_KEY)
