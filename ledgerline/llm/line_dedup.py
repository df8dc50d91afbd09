"""Line dedup over batches of documents, with levelled sorted runs of line hashes.

Documents come in batches. A batch reduces its lines to distinct hashes with the smallest id that
holds each, sorts them and merges them with the sorted runs of the batches before: a hash without
a partner in any run is new (the anti join), and the new ones are the batch's own run. Once a level
has ``FAN`` runs they are merged into one run of the next level, so a batch meets few runs however
many batches there were. Runs are bucketed and sorted by hash, so a run is never shuffled again.

A line is known by its key: white space ``[\\x20\\x09-\\x0D]`` stripped at both ends, A-Z in lower
case; keys shorter than ``MIN_CHARS`` code points are left alone. A key goes by two 64-bit hashes of
different seeds (chance of any clash among 10^12 lines below 10^-14). A key that two or more documents
hold keeps its lines, repeats included, in the document of the smallest id and loses all others.

A batch wins over later ones, so ids should rise with the batches; ``dedupe`` cuts a whole table so.
A run is complete when its folder has a success mark. A batch that is run again reads the runs of
earlier batches only, so it gives the same rows again; a run that broke off is written anew.

Null and empty texts are one empty line. Rows of one id are one document; rows without an id are one
document behind all others. Repeated rows each give a row. An empty table gives an empty result. Ids are
integers. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import hot_split_join
from ..sources.scratch import scratch_folder, written
from .words import ascii_lower, whole

MIN_CHARS = 10
BATCHES = 6
FAN = 3
HOT_LINES = 1000
SPACES = " \t\n\x0b\x0c\r"
HASHES = ["h1", "h2"]
DOCUMENT = "struct<none: boolean, id: bigint>"
KEYS = "h1 bigint, h2 bigint, seen boolean"
RUN = f"{KEYS}, first {DOCUMENT}, last {DOCUMENT}, n bigint"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _parts(text: Column) -> Column:
    return F.split(text, "\n")


def _first(column: str) -> Column:
    """Orders documents by id, those without an id last."""
    return F.struct(F.col(column).isNull().alias("none"), F.col(column).cast("bigint").alias("id"))


def line_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, body, pos, h1, h2)``: every line with a key of ``MIN_CHARS`` or more; ``body`` is a
    hash of the text, which tells rows of one id apart."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("body"), F.posexplode(_parts(F.col("text"))).alias("pos", "line"))
    rows = rows.where(F.char_length("line") >= MIN_CHARS)
    rows = rows.select("doc_id", "body", "pos", line_key(F.col("line")).alias("line"))
    rows = rows.where(F.char_length("line") >= MIN_CHARS)
    return rows.select(
        "doc_id", "body", "pos",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"),
    )


class LineRuns:
    """The runs below one folder; its state is the folder's content, so any session can go on."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, fan: int = FAN):
        self.spark, self.folder, self.fan = spark, folder.rstrip("/"), fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: dict[tuple[int, int], str] = {}

    def complete(self) -> list[tuple[int, int]]:
        """``(first batch, last batch)`` of every run that was written to its end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        system = path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = system.globStatus(path(f"{self.folder}/run-*-*/_SUCCESS")) or []
        names = [f.getPath().getParent().getName().split("-")[1:] for f in found]
        return sorted((int(a), int(b)) for a, b in names)

    def before(self, batch: int) -> list[tuple[int, int]]:
        """The fewest runs that hold the batches before ``batch``."""
        runs, at = [], 0
        whole_runs = [r for r in self.complete() if r[1] < batch]
        while largest := max((r for r in whole_runs if r[0] == at), key=lambda r: r[1], default=None):
            runs.append(largest)
            at = largest[1] + 1
        if at != batch:
            raise ValueError(f"batch {at} has no run yet; batches are added in order")
        return runs

    def path(self, run: tuple[int, int]) -> str:
        return f"{self.folder}/run-{run[0]}-{run[1]}"

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        rows = rows.repartition(self.buckets, *HASHES)
        writer = rows.write.mode("overwrite").bucketBy(self.buckets, *HASHES).sortBy(*HASHES)
        writer.option("path", self.path(run)).saveAsTable(name)
        self.tables[run] = name

    def _table(self, run: tuple[int, int]) -> DataFrame:
        if run not in self.tables:
            name = f"line_run_{uuid.uuid4().hex}"
            keys = ", ".join(HASHES)
            self.spark.sql(
                f"CREATE TABLE {name} ({KEYS}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.path(run)}'"
            )
            self.tables[run] = name
        return self.spark.table(self.tables[run])

    def keys(self, run: tuple[int, int]) -> DataFrame:
        """The hashes that came up first in the batches of a run."""
        return self._table(run).where("NOT seen").select(*HASHES)

    def add(self, batch: int, lines: DataFrame) -> None:
        """Add the run of a batch: its distinct hashes with their first and last document. Hashes that
        an earlier run holds are kept beside the new ones, marked ``seen``, for the decisions."""
        if (batch, batch) in self.complete():
            return
        found = lines.groupBy(*HASHES).agg(
            F.min(_first("doc_id")).alias("first"), F.max(_first("doc_id")).alias("last"),
            F.count(F.lit(1)).alias("n"),
        )
        seen = F.lit(False)
        for k, run in enumerate(self.before(batch)):
            old = self.keys(run).withColumn(f"in_{k}", F.lit(True))
            found = found.join(old.hint("merge"), HASHES, "left")
            seen = seen | F.col(f"in_{k}").isNotNull()
        self._write(found.select(*HASHES, "first", "last", "n", seen.alias("seen")), (batch, batch))
        self.compact()

    def compact(self) -> None:
        """Merge ``fan`` runs that are neighbours of one level into a run of the next."""
        runs = self.before(max((r[1] for r in self.complete()), default=-1) + 1)
        while len(tail := runs[-self.fan :]) == self.fan and len({b - a for a, b in tail}) == 1:
            merged = self.keys(tail[0])
            for run in tail[1:]:
                merged = merged.unionAll(self.keys(run))
            whole_run = (tail[0][0], tail[-1][1])
            self._write(merged.withColumn("seen", F.lit(False)), whole_run)
            runs[-self.fan :] = [whole_run]

    def decisions(self, batch: int) -> DataFrame:
        """Hashes of a batch that lose lines, with the document that keeps them: none if an earlier
        batch holds the key."""
        rows = self.spark.read.schema(RUN).parquet(self.path((batch, batch)))
        rows = rows.where(F.col("seen") | (F.col("first") != F.col("last")))
        keeper = F.when(~F.col("seen"), F.col("first"))
        return rows.select(F.lit(batch).alias("batch"), *HASHES, "n", F.lit(True).alias("again"), keeper.alias("keeper"))

    def close(self) -> None:
        """Take the runs out of the session's catalog; their files stay."""
        for name in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables = {}


def dropped(lines: DataFrame, decisions: DataFrame) -> DataFrame:
    """``(doc_id, body, gone)``: places of the lines that go, for documents that lose any.

    The commonest hashes are joined by broadcast (a bounded number), so a line that stands in a third
    of all documents is no hot key.
    """
    found = hot_split_join(
        lines, decisions, ["batch", *HASHES], "n", ["doc_id", "pos"], hot_rows=HOT_LINES
    )
    found = found.where(F.col("again") & ~F.col("keeper").eqNullSafe(_first("doc_id")))
    return found.groupBy("doc_id", "body").agg(F.collect_set("pos").alias("gone"))


def apply(docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)``: every row of ``docs`` without the lines in ``gone``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    rows = rows.withColumn("body", F.xxhash64("text"))
    gone = gone.select(F.col("doc_id").alias("of"), F.col("body").alias("of_body"), "gone")
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("body") == F.col("of_body")), "left")
    parts = _parts(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get("parts", i)), "\n")
    rows = rows.select("doc_id", "text", parts.alias("parts"), "gone")
    return rows.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.size("parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedupe_batch(
    docs: DataFrame, runs: LineRuns, batch: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One batch against all before it; adds its run. Batches are numbered 0, 1, ..."""
    lines = written(line_hashes(docs, doc_id, text).withColumn("batch", F.lit(batch)), "lines")
    runs.add(batch, lines)
    return apply(docs, dropped(lines, runs.decisions(batch)), doc_id, text)


def dedupe(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES,
    runs: LineRuns | None = None,
) -> DataFrame:
    """A whole table as batches of rising ids: ``(doc_id, text, n_lines, n_dropped)``.

    Texts are read twice: for the hashes, which are written by batch, and for the result.
    """
    spark = docs.sparkSession
    runs = runs or LineRuns(spark, scratch_folder(spark, "line-runs"))
    shares = [k / batches for k in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(doc_id, shares)).first()[0] or [] if shares else []
    number = sum((F.coalesce((F.col("doc_id") > c).cast("int"), F.lit(1)) for c in cuts), F.lit(0))
    folder = scratch_folder(spark, "lines")
    lines = line_hashes(docs, doc_id, text).withColumn("batch", number)
    lines.write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema(lines.schema).parquet(folder)
    decisions = None
    for batch in range(len(cuts) + 1):
        runs.add(batch, lines.where(F.col("batch") == batch))
        more = runs.decisions(batch)
        decisions = more if decisions is None else decisions.unionAll(more)
    runs.close()
    return apply(docs, dropped(lines, decisions), doc_id, text)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedupe(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM parts
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), held AS (
  SELECT key, min(doc_id) AS owner, count(DISTINCT doc_id) AS docs FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.*, coalesce(h.docs >= 2 AND h.owner <> k.doc_id, false) AS gone
  FROM keyed k LEFT JOIN held h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
