"""Queries by key. Each takes (spark, folder of the tables) and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from .. import constants as C, functions as G, schemas
from ..operators import audit, dedup, ids, upsert, worklist
from ..plans import clean as rules, finalize, split
from ..plans.ingest import ingest
from ..plans.jobs import run_steps
from ..sources.csv_files import any_charset, read_csv, write_csv
from ..sources.scratch import scratch_folder, written
from ..sources.tables import Tables
from . import inputs
from .inputs import PARAMS, dictionaries, raw, stage, unnumbered, without_run_times

QUERIES: dict[str, Callable] = {}


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


# ---- raw rows and column rules ----


@query
def raw_lineage(spark, sf_dir) -> DataFrame:
    return raw(spark, sf_dir)


@query
def validity_flags(spark, sf_dir):
    test = [F.col(c) for c in ("id", "hasfulltext", "publish_file")]
    return unnumbered(spark, sf_dir).select(
        *test,
        G.validity_flag(*test).alias("is_valid"),
        G.validity_reason(*test).alias("invalid_reason"),
    )


@query
def date_normalize(spark, sf_dir):
    return unnumbered(spark, sf_dir).select(
        "applicationdate",
        "publicationdate",
        G.normalize_date(F.col("applicationdate")).alias("application_date"),
        G.normalize_date(F.col("publicationdate")).alias("publication_date"),
        G.year_of(F.col("applicationyear")).alias("application_year"),
        G.year_of(F.col("publishyear")).alias("publication_year"),
    )


@query
def multi_value(spark, sf_dir):
    kind = F.col("patenttype")
    codes = G.multi_value(F.col("classcodelist"))
    return unnumbered(spark, sf_dir).select(
        "patenttype",
        G.multi_value(F.col("applicant")).alias("applicant"),
        G.multi_value(F.col("inventor")).alias("inventor"),
        G.multi_value(F.col("agent"), also="%").alias("agent"),
        G.unclassified_if_design(kind, codes).alias("intci_code"),
        G.unclassified_if_design(kind, F.col("mainclasscode")).alias("intci_main_code"),
        G.unclassified_if_design(kind, F.col("mainclassname")).alias("intci_main_name"),
    )


@query
def id_numbers(spark, sf_dir):
    return unnumbered(spark, sf_dir).select(
        "patentcode",
        G.number_without_country(F.col("patentcode")).alias("patent_no"),
        G.upper_or_null(F.col("publicationno")).alias("publication_no"),
        G.fulltext_flag(F.col("hasfulltext")).alias("is_fulltext"),
    )


@query
def address_split(spark, sf_dir):
    return unnumbered(spark, sf_dir).select(
        "applicantaddress",
        "applicantarea",
        G.address_without_zip(F.col("applicantaddress")).alias("applicant_address"),
        G.zip_of_address(F.col("applicantaddress")).alias("applicant_zipcode"),
        G.first_of_list(F.col("applicantarea")).alias("appl_province"),
    )


@query
def object_path(spark, sf_dir):
    paths = []
    for table_id in ("a", "d"):
        store = dictionaries(spark).store_of(table_id)
        path = G.object_path(F.lit(store.s3_path_base), F.col("publish_file"), table_id)
        paths += [F.lit(store.pid).alias(f"pid_{table_id}"), path.alias(f"s3_path_{table_id}")]
    return unnumbered(spark, sf_dir).select("publish_file", *paths)


@query
def legal_status_map(spark, sf_dir):
    rows = unnumbered(spark, sf_dir).select("id", "legalstatus")
    return dictionaries(spark).with_legal_status(rows, "legalstatus", "legal_status")


@query
def language_map(spark, sf_dir):
    rows = unnumbered(spark, sf_dir).select("id", F.col("language").alias("source_language"))
    return dictionaries(spark).with_language(rows, "source_language", "language")


# ---- Stage ----


@query
def standardize_full(spark, sf_dir):
    return without_run_times(stage(spark, sf_dir))


@query
def assign_ids(spark, sf_dir):
    numbered = raw(spark, sf_dir).select("batch_id", "_source_file", "_row_num")
    sizes = inputs.file_sizes(spark, sf_dir)
    return ids.assign_ids(numbered, sizes, ["_source_file", "batch_id"])


@query
def sparse_numbers(spark, sf_dir):
    """Rows numbered in the order of numbers that lie far apart, in their file and over all files."""
    rows = raw(spark, sf_dir).select("batch_id", "_source_file", "_row_num")
    rows = rows.withColumn("seq", F.expr("_row_num * 7919 % 1000003 * 1000000007 - _row_num"))
    return ids.number_rows(rows, ["_source_file"], "seq", "place", total="place_in_all", dense=False)


@query
def path_prune(spark, sf_dir):
    rows = stage(spark, sf_dir).select(
        "stage_id", "is_valid", "intci_main_name", F.col("intci_main_name").alias("before")
    )
    return rules.clean_paths(rows)


@query
def dedup_flag(spark, sf_dir):
    rows = stage(spark, sf_dir).select(
        "stage_id", "batch_id", "patent_id", "is_valid", "invalid_reason"
    )
    return dedup.flag_duplicates(rows)


@query
def dup_keys(spark, sf_dir):
    """Repeated ids; the key itself is shown in the spelling that the lowest id has."""
    rows = stage(spark, sf_dir).select("stage_id", "batch_id", "patent_id", "is_valid")
    return dedup.repeated_keys(rows).select("batch_id", "keep_id", "cnt")


@query
def region_fix(spark, sf_dir):
    columns = (
        "stage_id", "is_valid", "appl_country", "appl_province", "signory_item",
        "application_origin",
    )
    return rules.fix_region(stage(spark, sf_dir).select(*columns), dictionaries(spark))


def _cleaned(spark, sf_dir) -> DataFrame:
    return rules.clean(stage(spark, sf_dir), dictionaries(spark), PARAMS)


@query
def clean_full(spark, sf_dir):
    return without_run_times(_cleaned(spark, sf_dir))


@query
def restore_raw(spark, sf_dir):
    rows = stage(spark, sf_dir).select(
        "stage_id", "is_valid", "intci_main_name", "intci_name_raw"
    )
    return rules.restore_raw(rules.clean_paths(rows))


@query
def top_candidates(spark, sf_dir):
    """The 100 valid rows with the lowest id whose path has several parts or levels."""
    marks = (C.PATH_SEPARATOR, C.LEVEL_SEPARATOR)
    return worklist.first_candidates(stage(spark, sf_dir), "intci_main_name", marks, 100)


# ---- split and final tables ----


def _with_sizes(cleaned: DataFrame) -> DataFrame:
    """File sizes as a file check would fill them in."""
    size = (F.length("publish_file") * 98765).cast("double")
    return cleaned.withColumn("file_size", size)


def _checked(valid: DataFrame) -> DataFrame:
    """Valid rows after a file check that finds no file outside the usual folder."""
    missing = ~F.startswith(F.col("publish_file"), F.lit("files/"))
    return dedup.mark_invalid(valid, missing, "文件不存在")


@query
def split_valid(spark, sf_dir):
    return without_run_times(split.split_valid(_with_sizes(_cleaned(spark, sf_dir))))


@query
def split_invalid(spark, sf_dir):
    return without_run_times(split.split_invalid(_with_sizes(_cleaned(spark, sf_dir))))


@query
def final_valid(spark, sf_dir):
    valid = split.split_valid(_with_sizes(_cleaned(spark, sf_dir)))
    return finalize.final_valid(_checked(valid), PARAMS)


@query
def final_invalid(spark, sf_dir):
    # The copies of raw text stay in Stage: neither branch has them.
    rows = written(_with_sizes(_cleaned(spark, sf_dir)).drop(*schemas.RAW_COPIES), "cleaned")
    valid, invalid = _checked(split.split_valid(rows)), split.split_invalid(rows)
    late = finalize.failed_checks(valid, invalid, PARAMS, unique=True)
    return finalize.final_invalid(invalid.unionByName(late), PARAMS)


def _two_partitions(spark, sf_dir) -> list[DataFrame]:
    """Each batch as a partition table of its own, with ids from 1."""
    rows = stage(spark, sf_dir).select("stage_id", "batch_id", "patent_id", "patent_name",
                                       "is_valid", "_source_file", "_row_num")
    rows = rows.withColumnRenamed("stage_id", "_key")
    numbered = written(ids.number_rows(rows, ["batch_id"], "_key", "stage_id"), "partitions")
    numbered = numbered.drop("_key")
    return [numbered.where(F.col("batch_id") == b) for b in ("batch_1", "batch_2")]


@query
def shift_ids_rerun(spark, sf_dir):
    """The second partition behind the first; a second run changes nothing."""
    first, second = _two_partitions(spark, sf_dir)
    for _ in range(2):
        second = ids.shift_ids(second, "stage_id", *ids.shift_bounds(first, second))
    return second


@query
def merge_partitions(spark, sf_dir):
    """Both partitions in one table with ids that do not repeat."""
    first, second = _two_partitions(spark, sf_dir)
    second = ids.shift_ids(second, "stage_id", *ids.shift_bounds(first, second))
    return finalize.merge_sources(
        first.withColumn("data_source", F.lit("A")), second.withColumn("data_source", F.lit("D"))
    )


@query
def refresh_in_stock(spark, sf_dir):
    """Paths pruned in Stage after the split are brought over to the valid table."""
    columns = ("stage_id", "batch_id", "is_valid", "patent_id", "intci_main_name")
    rows = stage(spark, sf_dir).select(*columns)
    valid = rows.where((F.col("is_valid") == 1) & ~G.is_blank(F.col("patent_id"))).select(
        F.col("stage_id").alias("id"), "batch_id", "patent_id", "intci_main_name"
    )
    fixed = rules.clean_paths(rows).where(F.col("batch_id") == PARAMS.batch_id)
    return finalize.refresh_valid(valid, fixed, ["intci_main_name"])


# ---- logs, work lists and audits ----


def _file_log(spark, sf_dir) -> DataFrame:
    """A file log derived from the rows: two files have failed."""
    failed = F.col("file_name").isin("f3.csv", "f9.csv")
    rows = inputs.file_sizes(spark, sf_dir).withColumnRenamed("_source_file", "file_name")
    seconds = F.lit(1704067200) + F.col("rows_loaded") % 7 * 3600
    return rows.select(
        "batch_id",
        F.lit("ods_patents").alias("table_name"),
        "file_name",
        F.when(failed, C.STATUS_FAILED).otherwise(C.STATUS_OK).alias("status"),
        "rows_loaded",
        F.timestamp_seconds(seconds).alias("created_at"),
        F.timestamp_seconds(seconds).alias("updated_at"),
    )


def _done_log(spark, sf_dir) -> DataFrame:
    """Stage runs so far: even files are done, one has failed, others were not run."""
    log = _file_log(spark, sf_dir)
    number = F.substr("file_name", F.lit(2), F.lit(1)).cast("int")
    ran = log.where((number % 2 == 0) | (number == 7))
    return ran.select(
        "table_name",
        F.lit("stage_patents").alias("stage_table"),
        "batch_id",
        "file_name",
        F.when(number == 7, C.STATUS_FAILED).otherwise(C.STATUS_OK).alias("status"),
        "rows_loaded",
        "created_at",
        "updated_at",
    )


@query
def open_work(spark, sf_dir):
    log, done = _file_log(spark, sf_dir), _done_log(spark, sf_dir)
    names = ("ods_patents", "stage_patents")
    return worklist.open_work(log, done, *names, limit=50).select(
        F.lit("all_not_success").alias("mode"), "*"
    ).unionByName(
        worklist.open_work(log, done, *names, mode="retry_failed", limit=50).select(
            F.lit("retry_failed").alias("mode"), "*"
        )
    )


@query
def upsert_ledger(spark, sf_dir):
    """A second run of the failed files and one new file over the log."""
    log = _file_log(spark, sf_dir)
    later = F.col("updated_at") + F.expr("INTERVAL 1 DAY")
    again = log.where(F.col("status") == C.STATUS_FAILED).withColumns(
        {"status": F.lit(C.STATUS_OK), "created_at": later, "updated_at": later}
    )
    new = log.where("file_name = 'f0.csv'").withColumn("file_name", F.lit("f10.csv"))
    merged = upsert.upsert_rows(log, again.unionByName(new), schemas.FILE_LOG_KEY)
    text = "yyyy-MM-dd HH:mm:ss"
    return merged.withColumns(
        {c: F.date_format(c, text) for c in ("created_at", "updated_at")}
    )


@query
def delete_files(spark, sf_dir):
    rows = raw(spark, sf_dir).select("batch_id", "_source_file", "_row_num", "id")
    log = _file_log(spark, sf_dir).where(F.col("status") == C.STATUS_FAILED)
    files = log.select("batch_id", F.col("file_name").alias("_source_file"))
    return upsert.delete_files(rows, files)


@query
def file_audit(spark, sf_dir):
    """Loaded against inserted rows, for a Stage that holds valid rows only."""
    rows = stage(spark, sf_dir).where("is_valid = 1")
    return audit.file_audit(_file_log(spark, sf_dir), rows)


@query
def conservation(spark, sf_dir):
    columns = ("batch_id", "stage_id", "is_valid", "patent_id")
    cleaned = written(_cleaned(spark, sf_dir).select(*columns), "cleaned")
    return audit.routed(cleaned)


@query
def key_ranges(spark, sf_dir):
    """Lowest and highest id of each branch of each batch."""
    rows = stage(spark, sf_dir).select("batch_id", "is_valid", "stage_id")
    return audit.key_range(rows, "stage_id", ["batch_id", "is_valid"], empty=0)


@query
def run_totals(spark, sf_dir):
    return audit.run_totals(_file_log(spark, sf_dir))


@query
def touched_rows(spark, sf_dir):
    """Which rows the clean rules change: only these get a new date."""
    later = replace(PARAMS, run_ts=PARAMS.run_ts + timedelta(hours=1))
    rows = rules.clean(stage(spark, sf_dir), dictionaries(spark), later)
    return rows.select("stage_id", (F.col("updated_date") == F.lit(later.run_ts)).alias("touched"))


@query
def key_slice(spark, sf_dir):
    """Rows in the id range of two files."""
    rows = stage(spark, sf_dir).select("stage_id", "_source_file")
    return upsert.key_window(rows, rows.where(F.col("_source_file").isin("f2.csv", "f4.csv")), "stage_id")


@query
def lowest_open_key(spark, sf_dir):
    """Where the work that is still open begins, per batch."""
    rows = stage(spark, sf_dir).select("batch_id", "stage_id", F.col("_source_file").alias("file_name"))
    done = _done_log(spark, sf_dir).where(F.col("status") == C.STATUS_OK).select("batch_id", "file_name")
    left = rows.join(done, ["batch_id", "file_name"], "left_anti")
    return ids.lowest_keys(left, "stage_id", ["batch_id"], "open_key")


# ---- folders, logs and whole runs ----


@query
def csv_round_trip(spark, sf_dir):
    """All raw rows written as CSV files and read back."""
    folder = scratch_folder(spark, "round-trip")
    write_csv(unnumbered(spark, sf_dir).select(*schemas.RAW_COLUMNS), folder)
    return read_csv(spark, folder).select(*schemas.RAW_COLUMNS)


def _loaded(spark, sf_dir) -> tuple[Tables, DataFrame]:
    """Tables after a CSV folder with all raw rows was loaded, and again without new files."""
    root = scratch_folder(spark, "tables")
    rows = unnumbered(spark, sf_dir).select(*schemas.RAW_COLUMNS)
    write_csv(rows.repartition(16), f"{root}/csv")
    tables = Tables(spark, root)
    ingest(tables, PARAMS, f"{root}/csv", "full")
    later = replace(PARAMS, run_ts=PARAMS.run_ts + timedelta(hours=1))
    ingest(tables, later, f"{root}/csv", "resume")
    return tables, tables.read(PARAMS.file_log, schemas.FILE_LOG)


@query
def ingest_resume(spark, sf_dir):
    """Rows by batch and status after a full load and a resumed one that finds no open file."""
    _, log = _loaded(spark, sf_dir)
    return log.groupBy("batch_id", "status").agg(
        F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
        F.max((F.col("created_at") != F.col("updated_at")).cast("int")).alias("loaded_twice"),
    )


ALL_STEPS = "ods2stage,stage_clean,split,final_instock,final_unqualified"


@query
def default_steps(spark, sf_dir):
    """All steps over a loaded folder, run twice: rows by table and verdict."""
    tables, _ = _loaded(spark, sf_dir)
    for _ in range(2):
        run_steps(tables, dictionaries(spark), PARAMS, ALL_STEPS)
    counts = []
    for name, schema, verdict in (
        (PARAMS.stage_table, schemas.STAGE, F.col("is_valid")),
        (PARAMS.valid_table, schemas.PART, F.col("is_valid")),
        (PARAMS.invalid_table, schemas.PART, F.col("is_valid")),
        (PARAMS.final_valid_table, schemas.FINAL_VALID, F.lit(1)),
        (PARAMS.final_invalid_table, schemas.FINAL_INVALID, F.lit(0)),
    ):
        rows = tables.read(name, schema).groupBy(verdict.alias("is_valid"))
        counts.append(
            rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(name))
        )
    return finalize.merge_sources(*counts)


# Records of a file, and what is odd about some of them.
FILE_RECORDS = 250


def _odd_rows(spark, sf_dir) -> DataFrame:
    """The rows with the file they go to, some titles over several lines or with quotes in them."""
    rows = inputs.keyed(spark, sf_dir)
    k, title = F.col("k"), F.col("title")
    lines = F.concat(title, F.lit('"'), k.cast("string"), F.lit('"\n\n, and more\n'))
    new = F.when(k % 5 == 0, lines).when(k % 5 == 1, F.concat(F.lit('5" '), title)).otherwise(title)
    name = F.concat(F.lit("k"), F.lpad(F.floor(k / FILE_RECORDS).cast("string"), 6, "0"), F.lit(".csv"))
    return rows.withColumns({"title": new, "file": name})


def _csv_folder(spark, rows: DataFrame, folder: str) -> None:
    """One CSV file for each ``file`` of rows ``(file, k, text)``; a file has few of them."""
    header = ",".join(schemas.RAW_COLUMNS)
    body = F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"])
    files = rows.groupBy("file").agg(F.concat_ws("\n", F.lit(header), F.array_join(body, "\n")).alias("value"))
    files.write.partitionBy("file").text(f"{folder}-parts")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop(folder))
    for part in system.globStatus(hadoop(f"{folder}-parts/file=*/part-*")):
        name = part.getPath().getParent().getName().split("=", 1)[1]
        system.rename(part.getPath(), hadoop(f"{folder}/{name}"))


def _record_text() -> F.Column:
    options = {
        "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    return F.to_csv(F.struct(*schemas.RAW_COLUMNS), options)


@query
def odd_files(spark, sf_dir):
    """Rows and numbers of files with records over several lines, quotes and blank lines."""
    root = scratch_folder(spark, "odd")
    rows = _odd_rows(spark, sf_dir)
    text = _record_text()
    text = F.when(F.col("k") % 7 == 0, F.concat(text, F.lit("\n"))).otherwise(text)
    _csv_folder(spark, rows.select("file", "k", text.alias("text")), f"{root}/csv")
    tables = Tables(spark, f"{root}/tables")
    ingest(tables, PARAMS, f"{root}/csv", "full")
    return tables.read(PARAMS.ods_table, schemas.ODS).select(*schemas.RAW_COLUMNS, "_source_file", "_row_num")


@query
def encoded_files(spark, sf_dir):
    """The files of ``odd_files`` in another encoding, which is tried behind UTF-8."""
    root = scratch_folder(spark, "encoded")
    rows = _odd_rows(spark, sf_dir)
    text = F.when(F.col("k") % 7 == 0, F.concat(_record_text(), F.lit("\n"))).otherwise(_record_text())
    with any_charset(spark):
        rows = rows.select("file", "k", F.encode(text, "GB18030").cast("string").alias("text"))
    _csv_folder(spark, rows, f"{root}/csv")
    tables = Tables(spark, f"{root}/tables")
    ingest(tables, PARAMS, f"{root}/csv", "full", encodings=("UTF-8", "GB18030"))
    return tables.read(PARAMS.ods_table, schemas.ODS).select(*schemas.RAW_COLUMNS, "_source_file", "_row_num")


@query
def bad_files(spark, sf_dir):
    """The log of files of which some have a quote that is never closed, characters of another encoding,
    or records with too few or too many fields, with the rows and the odd records stored of each."""
    root = scratch_folder(spark, "bad")
    rows = _odd_rows(spark, sf_dir)
    k, kind = F.col("k"), F.floor(F.col("k") / FILE_RECORDS) % 6
    text = _record_text()
    text = (
        F.when((kind == 1) & (k % FILE_RECORDS == FILE_RECORDS - 1), F.lit('x,"open'))
        .when((kind == 2) & (k % 50 == 0), F.concat(F.unhex(F.lit("D6D0")).cast("string"), text))
        .when((kind == 3) & (k % 100 == 0), F.lit("too,few"))
        .when((kind == 4) & (k % 125 == 0), F.concat(text, F.lit(",too,many")))
        .otherwise(text)
    )
    plain = rows.withColumn("title", F.lit("t"))
    _csv_folder(spark, plain.select("file", "k", text.alias("text")), f"{root}/csv")
    tables = Tables(spark, f"{root}/tables")
    ingest(tables, PARAMS, f"{root}/csv", "full")
    log = tables.read(PARAMS.file_log, schemas.FILE_LOG)
    stored = tables.read(PARAMS.ods_table, schemas.ODS).groupBy("_source_file").agg(F.count(F.lit(1)).alias("stored"))
    odd = tables.read(PARAMS.bad_records, schemas.BAD_RECORDS).groupBy("file_name").agg(F.count(F.lit(1)).alias("odd"))
    return (
        log.join(stored, F.col("file_name") == F.col("_source_file"), "left").join(odd, "file_name", "left")
        .select("file_name", "status", "rows_loaded", "error_message", "stored", "odd")
    )


def _ods(spark, sf_dir, tables: Tables, params, batch_id: str, files: list[str] | None = None) -> None:
    """Put rows of a batch into the raw table and its files into the log."""
    rows = raw(spark, sf_dir).where(F.col("batch_id") == batch_id)
    if files:
        rows = rows.where(F.col("_source_file").isin(files))
    new = tables.write(rows.select(*schemas.ODS.fieldNames()), params.ods_table, "batch_id")
    tables.publish(new)
    sizes = tables.rows_of(new, schemas.ODS).groupBy("batch_id", F.col("_source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("rows_loaded"))
    entry = {
        "table_name": F.lit(params.ods_table), "status": F.lit(C.STATUS_OK),
        "created_at": F.lit(params.run_ts), "updated_at": F.lit(params.run_ts),
    }
    for field in schemas.FILE_LOG.fields:
        if field.name not in (*entry, "batch_id", "file_name", "rows_loaded"):
            entry[field.name] = F.lit(None).cast(field.dataType)
    log = sizes.withColumns(entry).select(*schemas.FILE_LOG.fieldNames())
    tables.upsert(log, params.file_log, schemas.FILE_LOG, schemas.FILE_LOG_KEY)


def _two_sources(spark, sf_dir) -> Tables:
    """Two partitions of one ``data_source``, finalised one after the other, the first one twice."""
    tables = Tables(spark, scratch_folder(spark, "two-sources"))
    first = replace(PARAMS, data_source="E")
    second = replace(
        first, batch_id="batch_2", ods_table="ods_d", stage_table="stage_d", valid_table="in_stock_d",
        invalid_table="unqualified_d", start_after=(first.stage_table,),
    )
    for params, batch in ((first, "batch_1"), (second, "batch_2")):
        _ods(spark, sf_dir, tables, params, batch)
        run_steps(tables, dictionaries(spark), params, ALL_STEPS)
    run_steps(tables, dictionaries(spark), first, ALL_STEPS)
    return tables


@query
def two_sources_final(spark, sf_dir):
    """Final valid rows of two partitions that share their ``data_source``."""
    return _two_sources(spark, sf_dir).read(PARAMS.final_valid_table, schemas.FINAL_VALID)


@query
def two_sources_invalid(spark, sf_dir):
    """Final invalid rows of two partitions that share their ``data_source``."""
    return _two_sources(spark, sf_dir).read(PARAMS.final_invalid_table, schemas.FINAL_INVALID)


@query
def run_log(spark, sf_dir):
    """What every job has entered for every batch: highest id and rows, taken while they were written."""
    log = _two_sources(spark, sf_dir).read(PARAMS.run_log, schemas.RUN_LOG)
    return log.where(~F.startswith("job_name", F.lit("clean"))).select(
        "batch_id", "target_table", "status", "last_key", F.col("inserted_rows"),
        F.regexp_replace("job_name", "_a_v1$|_v1$", "").alias("job"),
    )


@query
def resumed_batch(spark, sf_dir):
    """Stage of a batch whose second half came after the first was split, with a write that broke off."""
    tables = Tables(spark, scratch_folder(spark, "resumed"))
    halves = [[f"f{k}.csv" for k in range(4)], [f"f{k}.csv" for k in range(4, 8)]]
    for files in halves:
        _ods(spark, sf_dir, tables, PARAMS, PARAMS.batch_id, files)
        for _ in range(2):
            run_steps(tables, dictionaries(spark), PARAMS)
        lost = tables.read(PARAMS.stage_table, schemas.STAGE).withColumn("patent_id", F.lit("lost"))
        tables.write(lost.limit(10), PARAMS.stage_table, "batch_id")
    return without_run_times(tables.read(PARAMS.stage_table, schemas.STAGE))
