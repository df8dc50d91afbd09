"""The stored steps of a run. Each reads tables, applies a plan, writes and enters a log, so a
step that is run again continues or changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from .. import constants as C, schemas
from ..operators import audit
from ..operators.dedup import keep_first, key_counts, keys_to_flag, plain_key
from ..operators.ids import assign_ids, max_key, number_rows
from ..operators.joins import fits_broadcast, matching
from ..operators.upsert import delete_files, insert_ignore, key_window
from ..operators.worklist import open_work
from ..params import Params
from ..sources.dictionaries import Dictionaries
from ..sources.scratch import written
from ..sources.tables import Tables
from . import clean as rules, finalize, split
from .ingest import isolate_failures
from .standardize import standardize


# ---- raw table to Stage ----


def ods_to_stage(tables: Tables, dicts: Dictionaries, params: Params) -> None:
    """Standardise the files that are not in Stage yet and log rows loaded against inserted.

    If the whole list fails, parts of it are tried, and only files that fail alone are logged as
    FAILED.
    """
    log = tables.read(params.file_log, schemas.FILE_LOG)
    done = tables.read(params.done_log, schemas.DONE_LOG)
    work = open_work(
        log, done, params.ods_table, params.stage_table, params.mode, params.max_files
    )
    files = work.collect()
    failures = isolate_failures(files, lambda part: _stage_files(tables, dicts, params, part))
    if failures:
        rows = [(f.batch_id, f.file_name, f.rows_loaded, None, text) for f, text in failures]
        _log_done(tables, params, _entries(tables, rows), C.STATUS_FAILED)


_ENTRY = (
    "batch_id string, file_name string, rows_loaded long, rows_inserted long, err_msg string"
)


def _entries(tables: Tables, rows: list) -> DataFrame:
    return tables.spark.createDataFrame(rows, _ENTRY)


def _stage_files(tables: Tables, dicts: Dictionaries, params: Params, files: list) -> None:
    work = _entries(tables, [(f.batch_id, f.file_name, f.rows_loaded, None, None) for f in files])
    keys = work.select("batch_id", F.col("file_name").alias("_source_file"))
    batches = sorted({f.batch_id for f in files})
    ods = tables.read(params.ods_table, schemas.ODS, only=lambda b: b in batches)
    ods = matching(ods, keys, small=fits_broadcast(keys))
    left = _without_files(tables, params, keys, batches) if params.delete_before_insert else ([], [])
    start = max(
        [max_key(tables.read(t, schemas.STAGE), "stage_id")
         for t in (params.stage_table, *params.start_after)]
        + [_last_entered_key(tables, params)]
    )
    stage = stage_with_ids(ods, dicts, params, start)
    new = tables.write(stage.select(*schemas.STAGE.fieldNames()), params.stage_table, "batch_id")
    # Old rows of these files go and the new ones come in one step.
    kept, touched = left
    tables.publish(*kept, new, old=touched)
    counted = audit.rows_per_file(tables.rows_of(new, schemas.STAGE), work.drop("rows_inserted"))
    _log_done(tables, params, counted, C.STATUS_OK)


def stage_with_ids(
    ods: DataFrame, dicts: Dictionaries, params: Params, start: int = 0
) -> DataFrame:
    """Stage rows with dense ids after ``start`` in (file, row) order.

    Where files hold rows 1..n and no dictionary entry repeats, ids follow from the file sizes
    alone. Otherwise rows share a place, and the ids are counted over the joined rows.
    """
    by_file = ["_source_file", "batch_id"]
    sizes = written(
        ods.groupBy(*by_file).agg(
            F.count(F.lit(1)).alias("rows_loaded"), F.max("_row_num").alias("_last")
        ),
        "file-sizes",
    )
    plain = sizes.where("rows_loaded <> _last").isEmpty() and not dicts.multiplies_rows()
    if plain:
        numbered = assign_ids(ods, sizes.drop("_last"), by_file, start=start)
        return standardize(numbered, dicts, params)
    rows = standardize(ods, dicts, params)
    ties = ["patent_id", "legal_status", "language"]
    return number_rows(
        rows, by_file, "_row_num", "_in_file", ties=ties, total="stage_id", start=start
    ).drop("_in_file")


def _without_files(tables: Tables, params: Params, keys: DataFrame, batches: list[str]):
    """Stage without the rows that it has of these files, left by a run that broke off or by files
    that were replaced: new versions with the rows that stay, and the old ones they stand for. Versions
    without a row of these files are not written again."""
    def in_batches(batch) -> bool:
        return batch in batches

    touched = tables.versions_with(params.stage_table, schemas.STAGE, keys, in_batches)
    if not touched:
        return [], []
    old = tables.read(params.stage_table, schemas.STAGE, in_batches, touched)
    return [tables.write(delete_files(old, keys), params.stage_table, "batch_id")], touched


def _log_done(tables: Tables, params: Params, files: DataFrame, status: str) -> None:
    rows = files.withColumns(
        {
            "table_name": F.lit(params.ods_table),
            "stage_table": F.lit(params.stage_table),
            "status": F.lit(status),
            "rows_inserted": F.col("rows_inserted").cast("bigint"),
            "created_at": F.lit(params.run_ts),
            "updated_at": F.lit(params.run_ts),
        }
    ).select(*schemas.DONE_LOG.fieldNames())
    tables.upsert(rows, params.done_log, schemas.DONE_LOG, schemas.DONE_LOG_KEY)


# ---- progress per job, batch and target ----


class AuditError(ValueError):
    """Rows got lost or came up twice; nothing was put to use."""


def _last_entered_key(tables: Tables, params: Params) -> int:
    """Highest Stage id that a job has seen; rows that were replaced since do not free it."""
    jobs = F.col("job_name").isin(*_jobs(params))
    return max_key(tables.read(params.run_log, schemas.RUN_LOG).where(jobs), "last_key")


def _jobs(params: Params) -> tuple[str, str, str]:
    stems = ("clean_stage", "split_in_stock", "split_unqualified")
    return tuple(f"{stem}_{params.table_id}_v1" for stem in stems)


@dataclass(frozen=True)
class Work:
    """What a job still has to do for a batch: ``versions`` of its source are read, all of them
    (``whole``) or only those that came in since it was done. ``now`` is what the log gets."""

    versions: tuple[str, ...]
    whole: bool
    now: str


def open_versions(
    tables: Tables, params: Params, job: str, target: str, source: str, again: bool = False
) -> Work | None:
    """None if the job was done over the batch as its table has it now. No row is read for that."""
    log = tables.read(params.run_log, schemas.RUN_LOG, only=lambda b: b == params.batch_id).where(
        (F.col("job_name") == job)
        & (F.col("target_table") == target)
        & (F.col("status") == C.STATUS_OK)
    )
    entry = None if again else log.first()
    done = entry["source_version"].split(",") if entry and entry["source_version"] else []
    now = tables.versions(source, params.batch_id)
    if now == done:
        return None
    whole = not done or not set(done) <= set(now)
    versions = now if whole else [v for v in now if v not in done]
    return Work(tuple(versions), whole, ",".join(now))


def _log_run(
    tables: Tables, params: Params, job: str, target: str, version: str = "", *,
    last_key: int | None = 0, scanned: int = 0, updated: int = 0, inserted: int = 0,
    status: str = C.STATUS_OK,
) -> None:
    """Enter what a job has done to one batch, with the version of the batch that it worked on."""
    times = (params.run_ts, params.run_ts)
    entry = (job, params.batch_id, target, status, version, last_key or 0, scanned, updated, inserted, *times)
    row = tables.spark.createDataFrame([entry], schemas.RUN_LOG)
    tables.upsert(row, params.run_log, schemas.RUN_LOG, schemas.RUN_LOG_KEY, touched={params.batch_id})


def _batch(tables: Tables, params: Params, name: str, schema) -> DataFrame:
    return tables.read(name, schema, only=lambda b: b == params.batch_id)


# ---- clean, split ----


def clean_stage(
    tables: Tables, dicts: Dictionaries, params: Params, again: bool = False
) -> None:
    """Apply the rules to what has come into a batch since it was last cleaned.

    Earlier rows are not read again: of their ids, the stored keys say which are there already, and a
    repeated id stays with its lowest row, which is the older one. Only if rows of the batch were
    replaced or taken out, the whole batch is cleaned; the rules change cleaned rows no further.
    """
    job, name = _jobs(params)[0], params.stage_table
    work = open_versions(tables, params, job, name, name, again)
    if work is None:
        return

    def is_batch(batch) -> bool:
        return batch == params.batch_id

    rows = tables.read(name, schemas.STAGE, is_batch, work.versions)
    keys, keep, keys_table = None, None, f"{name}_keys"
    if "dedup" in params.rules:
        counted = plain_key(key_counts(rows)).select(*schemas.STAGE_KEYS.fieldNames())
        keys = tables.write(counted, keys_table, "batch_id")
        earlier = tables.read(keys_table, schemas.STAGE_KEYS, is_batch, [] if work.whole else None)
        keep = keys_to_flag(tables.rows_of(keys, schemas.STAGE_KEYS), earlier, ["batch_id"])
    moved = F.count_if(F.col("updated_date") == F.lit(params.run_ts))
    rows = rules.clean(rows, dicts, params, keep)
    new = tables.write(rows, name, "batch_id", last=F.max("stage_id"), moved=moved)
    tables.publish(new, old=work.versions)
    if keys is not None:
        tables.publish(keys, gone=is_batch if work.whole else None)
    _log_run(
        tables, params, job, name, ",".join(tables.versions(name, params.batch_id)),
        last_key=new.counts.get("last"), scanned=new.counts["rows"], updated=new.counts.get("moved", 0),
    )


def _swap_batch(tables: Tables, name: str, rows: DataFrame) -> None:
    tables.replace_partitions(rows, name, "batch_id")


def split_stage(tables: Tables, params: Params, again: bool = False) -> None:
    """Route one batch to the valid and the invalid table, sorted by id within files.

    Rows that a target has already stay as they are, with the results of file checks, unless
    Stage has lost them; only rows of other ids are added. Every row of Stage has to go to one of the
    two: if not, an ``AuditError`` is raised, the run is logged as FAILED, and both targets stay.
    """
    _, valid_job, invalid_job = _jobs(params)
    branches = [
        (job, target, plan, open_versions(tables, params, job, target, params.stage_table, again))
        for job, target, plan in (
            (valid_job, params.valid_table, split.split_valid),
            (invalid_job, params.invalid_table, split.split_invalid),
        )
    ]
    branches = [b for b in branches if b[-1] is not None]
    if not branches:
        return

    def is_batch(batch) -> bool:
        return batch == params.batch_id

    _all_routed(tables, params, branches)
    for job, target, plan, work in branches:
        stage = tables.read(params.stage_table, schemas.STAGE, is_batch, work.versions)
        rows = plan(stage, params.batch_id, params.min_key)
        existing = _batch(tables, params, target, schemas.PART)
        lost = False
        if not existing.isEmpty():
            rows = insert_ignore(rows, existing, "id")
            ids = stage.select(F.col("stage_id").alias("id"))
            lost = work.whole and not existing.select("id").join(ids, "id", "left_anti").isEmpty()
        if lost:
            rows = existing.join(ids, "id", "left_semi").unionByName(rows)
        new = tables.write(rows.sortWithinPartitions("id"), target, "batch_id", last=F.max("id"))
        tables.publish(new, gone=is_batch if lost else None)
        _log_run(
            tables, params, job, target, work.now,
            last_key=new.counts.get("last"), inserted=new.counts["rows"],
        )


def _all_routed(tables: Tables, params: Params, branches) -> None:
    """One scan of a few columns: rows of Stage against rows of both branches."""
    versions = {v for *_, work in branches for v in work.versions}
    stage = tables.read(params.stage_table, schemas.STAGE, lambda b: b == params.batch_id, versions)
    above = F.lit(True) if params.min_key is None else F.col("stage_id") > params.min_key
    counts = stage.where(above).agg(F.count(F.lit(1)), F.count_if(split.is_routed()))
    rows, routed = counts.first()
    if rows == routed:
        return
    for job, target, _, work in branches:
        _log_run(tables, params, job, target, work.now, scanned=rows, inserted=routed, status=C.STATUS_FAILED)
    raise AuditError(f"{rows - routed} of {rows} rows of {params.stage_table} go to neither table")


# ---- final tables ----

# Final tables are stored by the batch of the partition table that rows come from.
ORIGIN = ["data_source", "origin", "origin_batch"]


def finalize_valid(tables: Tables, params: Params) -> None:
    """Add the valid rows to the final table; rows that are there already are left out."""
    _finalize(
        tables, params, params.valid_table, params.final_valid_table, schemas.FINAL_VALID, finalize.final_valid
    )


def finalize_invalid(tables: Tables, params: Params) -> None:
    """Take rows that failed file checks to the invalid table, then all invalid rows to the
    final table."""
    for (batch,) in tables.partitions(params.valid_table):
        _take_failed_checks(tables, replace(params, batch_id=batch))
    _finalize(
        tables, params, params.invalid_table, params.final_invalid_table, schemas.FINAL_INVALID,
        finalize.final_invalid,
    )


def _take_failed_checks(tables: Tables, params: Params) -> None:
    job, target = f"failed_checks_{params.table_id}_v1", params.invalid_table
    work = open_versions(tables, params, job, target, params.valid_table)
    if work is None:
        return
    valid = tables.read(params.valid_table, schemas.PART, lambda b: b == params.batch_id, work.versions)
    invalid = _batch(tables, params, target, schemas.PART)
    late = finalize.failed_checks(valid, invalid, params).sortWithinPartitions("id")
    new = tables.write(late, target, "batch_id", last=F.max("id"))
    if new.partitions:
        tables.publish(new)
    _log_run(tables, params, job, target, work.now, last_key=new.counts.get("last"), inserted=new.counts["rows"])


def _finalize(tables: Tables, params: Params, source: str, target: str, schema, plan) -> None:
    """Bring what has come into a partition table since to the final table, batch by batch."""
    job = f"finalize_{source}_v1"
    batches = {b for (b,) in tables.partitions(source)}
    batches |= {b for _, origin, b in tables.partitions(target) if origin == source}
    for batch in sorted(batches, key=str):
        own = replace(params, batch_id=batch)
        work = open_versions(tables, own, job, target, source)
        if work is None:
            continue
        part = tables.read(source, schemas.PART, lambda b: b == batch, work.versions)  # noqa: B023
        rows = plan(_one_per_id(part), own)
        counts = _add_batch(tables, own, source, rows, part.select("id"), work.whole, target, schema)
        _log_run(tables, own, job, target, work.now, last_key=counts.get("last"), inserted=counts["rows"])


def _one_per_id(rows: DataFrame) -> DataFrame:
    """First row per id. Ids hardly ever repeat, so only the ids are counted to find out."""
    if rows.groupBy("id").count().where("count > 1").isEmpty():
        return rows
    return keep_first(rows, "id", ["_source_file", "_row_num"])


def _add_batch(
    tables: Tables, params: Params, source: str, rows: DataFrame, ids: DataFrame, whole: bool,
    target: str, schema,
) -> dict:
    """Add the rows of one batch whose ids are new.

    What the final table has of this batch stays as it is, but for rows whose ids are no longer in the
    partition table (``ids``, if that is ``whole``): their file was replaced. Rows of other batches and partition tables are
    not touched, also of the same ``data_source``. An id that stands there for another source or
    another patent is an error, and nothing is written: two partitions share ids, and one of them has
    to be placed behind the other.
    """
    def is_own(_, origin, batch) -> bool:
        return (origin, batch) == (source, params.batch_id)

    own = tables.read(target, schema, only=is_own)
    others = tables.read(target, schema, only=lambda *part: not is_own(*part))
    near = key_window(others, rows, "id").select(
        "id", F.col("data_source").alias("_source"), F.col("patent_id").alias("_patent")
    )
    other = ~(
        F.col("_source").eqNullSafe(F.col("data_source"))
        & F.col("_patent").eqNullSafe(F.col("patent_id"))
    )
    clash = rows.select("id", "data_source", "patent_id").join(near, "id").where(other).count()
    if clash:
        raise ValueError(f"{clash} ids of {target} belong to other rows; place the ids first")
    new = insert_ignore(rows, near.select("id").unionAll(own.select("id")), "id")
    lost = whole and not own.select("id").join(ids, "id", "left_anti").isEmpty()
    if lost:
        new = own.join(ids, "id", "left_semi").unionByName(new)
    new = new.withColumns({"origin": F.lit(source), "origin_batch": F.lit(params.batch_id)})
    version = tables.write(new.sortWithinPartitions("id"), target, ORIGIN, last=F.max("id"))
    if lost or version.partitions:
        tables.publish(version, gone=is_own if lost else None)
    return version.counts


# ---- ids of partitions, repairs ----


def place_behind(tables: Tables, params: Params, previous_stage: str) -> None:
    """Move the ids of a partition of any size behind those of ``previous_stage``.

    Each batch of each table is moved by itself: its lowest id and the offset are entered before
    and the end after, and the move replaces one folder. A run that goes on after a break reads
    from the entry what the lowest id was, so nothing is moved twice.
    """
    offset = max_key(tables.read(previous_stage, schemas.STAGE), "stage_id")
    if offset <= 0:
        raise ValueError("the table in front is empty: there is no offset to shift by")
    job = f"place_behind_{previous_stage}"
    for name, schema, key in (
        (params.valid_table, schemas.PART, "id"),
        (params.invalid_table, schemas.PART, "id"),
        (params.stage_table, schemas.STAGE, "stage_id"),
    ):
        lows = tables.read(name, schema).groupBy("batch_id").agg(F.min(key).alias("low"))
        for batch, low in sorted(tuple(r) for r in lows.collect()):
            _move_batch(tables, replace(params, batch_id=batch), job, (name, schema, key), low, offset)


def _move_batch(tables: Tables, params: Params, job: str, table, low: int, offset: int) -> None:
    name, schema, key = table
    log = tables.read(params.run_log, schemas.RUN_LOG, only=lambda b: b == params.batch_id)
    entry = log.where((F.col("job_name") == job) & (F.col("target_table") == name)).first()
    if entry is not None and entry["status"] == C.STATUS_OK:
        return
    old_low = low
    if entry is None:
        _log_run(tables, params, job, name, last_key=low, scanned=offset, status=C.STATUS_STARTED)
    else:
        old_low, offset = entry["last_key"], entry["scanned_rows"]
    if low == old_low:
        rows = _batch(tables, params, name, schema)
        _swap_batch(tables, name, rows.withColumn(key, (F.col(key) + offset).cast("bigint")))
    _log_run(tables, params, job, name, last_key=old_low, scanned=offset)


def _carry_on(tables: Tables, params: Params, before: list[str], after: list[str]) -> None:
    """Jobs that were done over a batch before a repair are done over it after that, too."""
    log = tables.read(params.run_log, schemas.RUN_LOG, only=lambda b: b == params.batch_id)
    done = log.where(F.col("source_version") == ",".join(before))
    done = done.withColumn("source_version", F.lit(",".join(after)))
    if not done.isEmpty():
        tables.upsert(done, params.run_log, schemas.RUN_LOG, schemas.RUN_LOG_KEY)


def restore_raw_names(tables: Tables, params: Params) -> None:
    """Put raw classification names back in one batch of Stage."""
    _repair(tables, params, params.stage_table, schemas.STAGE, "stage_id", rules.restore_raw)


def refresh_valid_names(tables: Tables, params: Params) -> None:
    """Bring classification names of one batch of Stage over to the valid table."""
    stage = _batch(tables, params, params.stage_table, schemas.STAGE)
    _repair(
        tables, params, params.valid_table, schemas.PART, "id",
        lambda valid: finalize.refresh_valid(valid, stage, ["intci_main_name"]),
    )


def _repair(tables: Tables, params: Params, name: str, schema, key: str, rule: Callable[[DataFrame], DataFrame]) -> None:
    """Rewrite the versions of a batch in which a rule changes a classification name, and no others.

    The names alone are compared first; wide rows are read of the versions that change.
    """
    def is_batch(batch) -> bool:
        return batch == params.batch_id

    before = tables.versions(name, params.batch_id)
    rows = tables.read(name, schema, is_batch)
    column = "intci_main_name"
    new = rule(rows).select(key, F.col(column).alias("_new"))
    changed = rows.select(key, column).join(new, key).where(~F.col("_new").eqNullSafe(F.col(column)))
    touched = tables.versions_with(name, schema, written(changed.select(key).distinct(), "changed"), is_batch)
    if not touched:
        return
    tables.publish(tables.write(rule(tables.read(name, schema, is_batch, touched)), name, "batch_id"), old=touched)
    _carry_on(tables, params, before, tables.versions(name, params.batch_id))


# ---- steps by name ----

STEPS: dict[str, Callable[[Tables, Dictionaries, Params], None]] = {
    "ods2stage": ods_to_stage,
    "stage_clean": clean_stage,
    "split": lambda tables, dicts, params: split_stage(tables, params),
    "final_instock": lambda tables, dicts, params: finalize_valid(tables, params),
    "final_unqualified": lambda tables, dicts, params: finalize_invalid(tables, params),
}
STEPS["stage_split"] = STEPS["split"]
DEFAULT_STEPS = "ods2stage,stage_clean,split"


def run_steps(
    tables: Tables,
    dicts: Dictionaries,
    params: Params,
    steps: str | Iterable[str] = DEFAULT_STEPS,
) -> None:
    """Run steps in the given order. All names are checked before the first step starts."""
    names = steps.split(",") if isinstance(steps, str) else list(steps)
    names = [n.strip() for n in names if n.strip()]
    unknown = [n for n in names if n not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps {unknown}; known: {sorted(STEPS)}")
    for name in names:
        STEPS[name](tables, dicts, params)
    tables.remove_old(
        (params.stage_table, params.valid_table, params.invalid_table, params.final_valid_table,
         params.final_invalid_table, f"{params.stage_table}_keys", params.done_log, params.run_log)
    )
