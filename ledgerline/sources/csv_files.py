"""CSV folders: listing, reading with lineage, writing."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import constants as C, schemas
from ..operators.joins import fits_broadcast, hot_split_join
from .scratch import scratch_folder, written

# Quotes count only at the start of a field; behind its closing quote a field goes on to the next
# comma, as Spark's reader has it.
_FIELD = r'(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+)?'
_REST = rf"(?:,{_FIELD})*+\z"
# A line that begins outside quotes and ends outside, and one that begins inside and ends outside.
CLOSED_LINE = rf"\A{_FIELD}{_REST}"
CLOSING_LINE = rf'\A(?:[^"]|"")*+"[^,]*+{_REST}'


def _decoded(name: Column) -> Column:
    """File name without the %-escapes of a URI (a plus stays a plus)."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


# Names that a path given to a reader would be a pattern for, and names that readers leave out.
PATTERN_CHARACTER = re.compile(r"([\[\]{}*?\\^])")
HIDDEN = re.compile(r"^[_.]")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """file_path, file_name, file_size, file_mtime (whole seconds) of the CSV files of a folder.

    The folder is listed through the file system, so names that Spark's readers pass over or take
    for patterns are there too. Office lock files (`~$...`) are left out. No content is read.
    """
    system, place = _file_system(spark, folder)
    rows = []
    for status in system.listStatus(place):
        path = status.getPath()
        name = path.getName()
        if status.isFile() and fnmatch.fnmatchcase(name, pattern) and not name.startswith("~$"):
            rows.append((path.toString(), name, status.getLen(), status.getModificationTime() // 1000))
    found = spark.createDataFrame(
        sorted(rows), "file_path string, file_name string, file_size long, seconds long"
    )
    return found.select(
        "file_path", "file_name", "file_size", F.timestamp_seconds("seconds").alias("file_mtime")
    )


def _readable(spark: SparkSession, files: list[str]) -> tuple[dict[str, str], dict[str, str]]:
    """Path to hand to a reader for each file, and the true names of files that were copied.

    Signs of patterns are escaped. Spark's readers leave out files that begin with `_` or `.`, so
    such a file is copied to the shared folder under another name.
    """
    paths, names = {}, {}
    for file in files:
        folder, _, name = file.rpartition("/")
        if HIDDEN.match(name):
            copy = f"{scratch_folder(spark, 'hidden-csv')}.csv"
            (source, old), (target, new) = _file_system(spark, file), _file_system(spark, copy)
            hadoop = spark._jsc.hadoopConfiguration()
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(source, old, target, new, False, hadoop)
            names[copy.rsplit("/", 1)[1]] = name
            paths[file] = copy
        else:
            paths[file] = PATTERN_CHARACTER.sub(r"\\\1", file)
    return paths, names


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    *,
    encoding: str = "UTF-8",
    multi_line: bool = True,
    null_text: bool = False,
    strip_return: bool = True,
) -> DataFrame:
    """The 30 text columns by position, header skipped, plus ``_source_file`` and ``_block``.

    An empty field is `''`, as are the fields that a short row lacks. ``multi_line`` allows line
    ends within quotes and makes one file one task; without it a file of any size is split.
    ``null_text`` reads the text NULL as NULL. ``strip_return`` drops the `\\r` that files with
    CRLF leave on the last column.
    """
    reader = spark.read.schema(schemas.RAW).options(**csv_reader_options(encoding, multi_line))
    rows = reader.option("pathGlobFilter", "*.csv").csv(paths)
    return tidy_csv(rows, null_text, strip_return)


def csv_reader_options(encoding: str = "UTF-8", multi_line: bool = True) -> dict:
    """Columns by position, whatever the header says; short rows are filled up."""
    return {
        "header": True, "enforceSchema": True, "sep": ",", "quote": '"', "escape": '"',
        "lineSep": "\n", "multiLine": multi_line, "mode": "PERMISSIVE", "encoding": encoding,
    }


def tidy_csv(rows: DataFrame, null_text: bool = False, strip_return: bool = True) -> DataFrame:
    columns = {c: F.coalesce(F.col(c), F.lit("")) for c in schemas.RAW_COLUMNS}
    if strip_return:
        last = schemas.RAW_COLUMNS[-1]
        columns[last] = F.regexp_replace(columns[last], "\r$", "")
    if null_text:
        columns = {c: F.nullif(v, F.lit("NULL")) for c, v in columns.items()}
    return rows.select(
        *[v.alias(c) for c, v in columns.items()],
        _decoded(F.col("_metadata.file_name")).alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    ).where(~F.startswith("_source_file", F.lit("~$")))


class Loaded(NamedTuple):
    """``rows``: the columns of the files with ``_source_file``, ``_row_num`` and ``_record``, the text
    of a record that has other than 30 fields (else NULL). ``bad_files``: why files cannot be loaded;
    their rows are not in ``rows``."""

    rows: DataFrame
    bad_files: dict[str, str]


# Charsets (by their canonical names) that have the byte of a line feed in no other character, so files
# can be cut at line feeds before they are decoded.
CUT_AT_LINES = re.compile("UTF-8$|US-ASCII$|ISO-8859-|windows-|GB|Big5|EUC-|Shift_JIS|KOI8")
# Without these, few charsets are at hand and undecodable characters end the job; they hold for an
# expression from when it is analysed on.
_ANY_CHARSET = {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"}
_LOOKUPS = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "48"}
UNDECODABLE = "lines that are not valid in"
UNCLOSED = "a quote is never closed"
_PLACE = ["_source_file", "_block"]


def read_files(
    spark: SparkSession, sizes: dict[str, int], encoding: str = "UTF-8", **options
) -> Loaded:
    """Records of files, numbered from 1 in each file behind its header.

    Files are read in splits of any size, also where records span lines; only files of encodings
    that cannot be cut at line feeds, such as UTF-16, are read one per task, without their empty lines.
    A file with undecodable characters or with a quote that is still open at its end is bad as a whole.
    """
    paths, names = _readable(spark, list(sizes))
    if CUT_AT_LINES.match(spark._jvm.java.nio.charset.Charset.forName(encoding).name()):
        loaded = _read_split(spark, sorted(set(paths.values())), encoding, **options)
    else:
        rows = with_row_numbers(read_csv(spark, sorted(set(paths.values())), encoding=encoding, **options))
        damaged = damaged_files(rows, encoding)
        if damaged:
            rows = rows.where(~F.col("_source_file").isin(sorted(damaged)))
        loaded = Loaded(rows.withColumn("_record", F.lit(None).cast("string")), damaged)
    if not names:
        return loaded
    true = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    own = F.coalesce(F.element_at(true, F.col("_source_file")), F.col("_source_file"))
    bad = {names.get(k, k): v for k, v in loaded.bad_files.items()}
    return Loaded(loaded.rows.withColumn("_source_file", own), bad)


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for what is planned within; the session's own stay."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def any_charset(spark: SparkSession):
    """Plans that are made within may use every charset of the JVM."""
    return _settings(spark, _ANY_CHARSET)


def _decoded_lines(lines: DataFrame, encoding: str) -> DataFrame:
    """``lines`` with their ``value`` as text and whether it has characters that cannot be read."""
    spark = lines.sparkSession
    place = [F.col("_metadata"), F.monotonically_increasing_id().alias("_place")]
    if spark._jvm.java.nio.charset.Charset.forName(encoding).name() == "UTF-8":
        return lines.select(*place, "value", (~F.is_valid_utf8("value")).alias("_undecodable"))
    with any_charset(spark):
        text = lines.select(*place, F.decode(F.col("value").cast("binary"), encoding).alias("value"))
    return text.withColumn("_undecodable", F.contains("value", F.lit("\ufffd")))


def _read_split(
    spark: SparkSession, paths: list[str], encoding: str = "UTF-8", *,
    null_text: bool = False, strip_return: bool = True,
) -> Loaded:
    """One scan stores the lines with their places; all else is taken from there.

    Where every line closes its quotes, a line is a record and its number follows from its place.
    Only the lines of other files are put in order, each block by itself.
    """
    # Else each of many paths is looked up by a task of its own.
    with _settings(spark, _LOOKUPS):
        lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.csv").text(paths)
    value = F.col("value")
    quoted = F.contains(value, F.lit('"'))
    stored = written(
        _decoded_lines(lines, encoding).select(
            _decoded(F.col("_metadata.file_name")).alias("_source_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            "_place",
            "value",
            F.when(quoted, ~value.rlike(CLOSED_LINE)).otherwise(False).cast("int").alias("_from_0"),
            "_undecodable",
        ),
        "csv-lines",
    )
    blocks = written(
        stored.groupBy(*_PLACE).agg(
            F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_lines"),
            F.max("_from_0").alias("_open"), F.count_if("_undecodable").alias("_bad"),
        ),
        "csv-blocks",
    )
    of_files = blocks.groupBy("_source_file").agg(F.max("_open").alias("_spans"), F.sum("_bad").alias("_bad"))
    bad = {
        r[0]: f"{r[1]} {UNDECODABLE} {encoding}"
        for r in of_files.where("_bad > 0").select("_source_file", "_bad").toLocalIterator()
    }
    good = blocks.drop("_bad").join(of_files.where("_bad = 0").drop("_bad"), "_source_file")
    records = _one_line_records(stored, good.where("_spans = 0"))
    spanning = good.where("_spans = 1")
    if not spanning.isEmpty():
        more, unclosed = _spanning_records(stored, spanning)
        records = records.unionByName(more)
        bad.update({name: UNCLOSED for name in unclosed})
    return Loaded(_parsed(records, null_text, strip_return), bad)


def _with_blocks(lines: DataFrame, blocks: DataFrame, weight: str) -> DataFrame:
    """Lines with the columns of their block; lines of other blocks are left out. There is a row per
    block of a file, so the table is small; a longer one is joined with its largest blocks split off."""
    if fits_broadcast(blocks):
        return lines.join(F.broadcast(blocks), _PLACE)
    found = hot_split_join(lines, blocks.withColumn("_found", F.lit(True)), _PLACE, weight, ["_place"])
    return found.where("_found")


def _one_line_records(stored: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(_source_file, _number, value)``; no line is moved."""
    in_file = Window.partitionBy("_source_file").orderBy("_block")
    blocks = blocks.select(*_PLACE, "_first", "_lines", (F.sum("_lines").over(in_file) - F.col("_lines")).alias("_before"))
    rows = _with_blocks(stored.select(*_PLACE, "_place", "value"), blocks, "_lines")
    number = F.col("_before") + F.col("_place") - F.col("_first") + 1
    return rows.select("_source_file", number.alias("_number"), "value")


def _chained(rows: DataFrame, groups: list[str], order: str) -> DataFrame:
    """Whether a row begins inside quotes, from what each row makes of both cases.

    ``_from_0`` and ``_from_1`` are the states behind a row that begins outside (0) and inside (1). Rows
    with one result whatever the beginning fix the state; behind the last of them, or behind the
    beginning of the group, only rows that turn the state round count. ``_fixed`` is the state behind the
    last fixing row before this one, NULL if there is none, ``_turns`` the turns since.
    """
    up_to = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.col("_from_0") > F.col("_from_1")).cast("int")
    rows = rows.withColumn("_all_turns", F.sum(turn).over(up_to))
    fixing = F.when(F.col("_from_0") == F.col("_from_1"), F.struct(F.col("_from_0").alias("state"), F.col("_all_turns").alias("turns")))
    rows = rows.withColumn("_last", F.last(fixing, ignorenulls=True).over(before))
    turns = F.col("_all_turns") - turn - F.coalesce(F.col("_last.turns"), F.lit(0))
    return rows.select(
        *[c for c in rows.columns if c not in ("_all_turns", "_last")],
        F.col("_last.state").alias("_fixed"), turns.alias("_turns"),
    )


def _state(begin) -> Column:
    """The state before a row of ``_chained`` whose group begins in a state."""
    return ((F.coalesce("_fixed", F.lit(begin)) + F.col("_turns")) % 2).cast("int")


def _behind(state: Column) -> Column:
    return F.when(state == 0, F.col("_from_0")).otherwise(F.col("_from_1"))


def _spanning_records(stored: DataFrame, blocks: DataFrame) -> tuple[DataFrame, list[str]]:
    """``(_source_file, _number, value)`` of files with records over several lines, and the names of
    files whose last quote is never closed.

    Each block finds, for both cases of its beginning, the states and the number of records; prefix
    sums over the blocks of a file, one row each, say which case it is and how many records are
    before. Only the lines of records over several lines are then put together.
    """
    lines = _with_blocks(stored.select(*_PLACE, "_place", "value", "_from_0"), blocks.select(*_PLACE, "_lines"), "_lines")
    quoted = F.contains("value", F.lit('"'))
    from_1 = F.when(quoted, ~F.col("value").rlike(CLOSING_LINE)).otherwise(True).cast("int")
    lines = _chained(lines.drop("_lines").withColumn("_from_1", from_1), _PLACE, "_place")
    in_block = Window.partitionBy(*_PLACE).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumns({f"_in_{b}": _state(b) for b in (0, 1)})
    lines = lines.withColumns({f"_records_{b}": F.sum(1 - F.col(f"_in_{b}")).over(in_block) for b in (0, 1)})
    lines = written(lines.drop("_fixed", "_turns"), "csv-states")
    last = lines.groupBy(*_PLACE).agg(
        F.count(F.lit(1)).alias("_lines"),
        *[F.max_by(_behind(F.col(f"_in_{b}")), "_place").alias(f"_from_{b}") for b in (0, 1)],
        *[F.max(f"_records_{b}").alias(f"_records_{b}") for b in (0, 1)],
    )
    # A file begins outside quotes.
    chain = _chained(last, ["_source_file"], "_block").withColumn("_begin", _state(0))
    count = F.when(F.col("_begin") == 0, F.col("_records_0")).otherwise(F.col("_records_1"))
    in_file = Window.partitionBy("_source_file").orderBy("_block")
    chain = chain.select(
        *_PLACE, "_lines", "_begin", (F.sum(count).over(in_file) - count).alias("_before"),
        _behind(F.col("_begin")).alias("_end"),
    )
    chain = written(chain, "csv-chain")
    ends = chain.groupBy("_source_file").agg(F.max_by("_end", "_block").alias("_end"))
    unclosed = [r[0] for r in ends.where("_end = 1").select("_source_file").toLocalIterator()]
    closed = chain.drop("_end").join(ends.where("_end = 0").select("_source_file"), "_source_file")
    rows = _with_blocks(lines, closed, "_lines")

    def by_case(stem: str) -> Column:
        return F.when(F.col("_begin") == 0, F.col(f"{stem}_0")).otherwise(F.col(f"{stem}_1"))

    rows = rows.select(
        *_PLACE, "_place", "value", by_case("_in").alias("_start"), _behind(by_case("_in")).alias("_end"),
        (F.col("_before") + by_case("_records")).alias("_number"),
    )
    alone = (F.col("_start") == 0) & (F.col("_end") == 0)
    parts = rows.where(~alone).groupBy("_source_file", "_number").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_place", "value"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda x: x["value"]), "\n")
    columns = ["_source_file", "_number", "value"]
    return rows.where(alone).select(*columns).unionByName(
        parts.select("_source_file", "_number", joined.alias("value"))
    ), unclosed


def _parsed(records: DataFrame, null_text: bool, strip_return: bool) -> DataFrame:
    """Fields of records behind the header. A blank line is a row with empty fields."""
    if strip_return:
        records = records.withColumn("value", F.regexp_replace("value", "\r\\z", ""))
    options = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    schema = ", ".join(f"`{c}` string" for c in (*schemas.RAW_COLUMNS, "_corrupt"))
    rows = records.where("_number > 1").select(
        "_source_file", (F.col("_number") - 1).cast("bigint").alias("_row_num"), "value",
        (F.trim("value") == "").alias("_blank"), F.from_csv("value", schema, options).alias("_fields"),
    )
    columns = {}
    for c in schemas.RAW_COLUMNS:
        blank = F.col("value") if c == schemas.RAW_COLUMNS[0] else F.lit("")
        field = F.when(F.col("_blank"), blank).otherwise(F.coalesce(F.col("_fields")[c], F.lit("")))
        columns[c] = F.nullif(field, F.lit("NULL")) if null_text else field
    record = F.when(~F.col("_blank"), F.col("_fields")["_corrupt"])
    return rows.select(
        *[v.alias(c) for c, v in columns.items()], "_source_file", "_row_num", record.alias("_record")
    )


def with_row_numbers(rows: DataFrame) -> DataFrame:
    """Add ``_row_num`` 1, 2, ... per file in text order; drops ``_block``.

    The rows are written once with their place in the scan, so that counts and numbers are taken
    from the same places even if tasks are repeated. Rows of one block stand together in one
    task; their numbers need only the row counts of the blocks before. No file is sorted or
    brought to one task.
    """
    place = F.monotonically_increasing_id()
    stored = written(rows.withColumn("_place", place), "csv-rows")
    keys = ["_source_file", "_block"]
    in_file = Window.partitionBy("_source_file").orderBy("_block")
    blocks = stored.groupBy(*keys).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    blocks = blocks.withColumn("_before", F.sum("_rows").over(in_file) - F.col("_rows"))
    if fits_broadcast(blocks):
        joined = stored.join(F.broadcast(blocks), keys)
    else:
        joined = hot_split_join(stored, blocks, keys, "_rows", ["_place"])
    number = F.col("_before") + F.col("_place") - F.col("_first") + 1
    kept = [c for c in rows.columns if c != "_block"]
    return joined.select(*kept, number.cast("bigint").alias("_row_num"))


def damaged_files(rows: DataFrame, encoding: str) -> dict[str, str]:
    """Files with rows that have characters the encoding could not read."""
    bad = F.contains(F.concat_ws("", *schemas.RAW_COLUMNS), F.lit("\ufffd"))
    found = rows.where(bad).groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"))
    return {r[0]: f"{r[1]} {UNDECODABLE} {encoding}" for r in found.toLocalIterator()}


def write_csv(
    df: DataFrame, path: str, *, line_end: str = "\n", single_file: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Export all columns with a header; NULL is an empty field, quotes only where needed.

    ``line_end='\\r\\n'`` also changes line ends within fields. ``single_file`` writes through
    one task; leave it off for large tables.
    """
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).options(
        header=True, quote='"', escape='"', lineSep=line_end, nullValue="", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_failed_list(file_log: DataFrame, path: str) -> bool:
    """`path<TAB>error` per failed file; nothing is written if no file has failed."""
    failed = file_log.where(F.col("status") == C.STATUS_FAILED)
    if failed.isEmpty():
        return False
    failed.select(F.concat_ws("\t", "file_path", "error_message")).coalesce(1).write.mode("overwrite").text(path)
    return True


