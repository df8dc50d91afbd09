"""New CSV files to the raw table and Stage as they arrive.

The stream says which files are new; its checkpoint remembers them. Each micro-batch is a batch of its
own and goes the way of a batch run: raw table, file log with failed files by themselves, Stage. A
micro-batch that is repeated after a failure finds in the log what it has done already.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..params import Params
from ..plans.ingest import ingest
from ..plans.jobs import ods_to_stage
from ..sources.dictionaries import Dictionaries
from ..sources.tables import Tables

# The columns of Spark's reader of whole files.
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Stream of new CSV files, at most ``max_files`` per micro-batch: file_path, file_name, file_size,
    file_mtime. No content is read. Names that begin with ``_`` or ``.`` are passed over by streams."""
    reader = spark.readStream.format("binaryFile").schema(FILES)
    rows = reader.option("maxFilesPerTrigger", max_files).option("pathGlobFilter", "*.csv").load(folder)
    name = F.substring_index("path", "/", -1)
    return rows.where(~F.startswith(name, F.lit("~$"))).select(
        F.col("path").alias("file_path"),
        name.alias("file_name"),
        F.col("length").alias("file_size"),
        F.date_trunc("second", "modificationTime").alias("file_mtime"),
    )


def start_ingest(
    tables: Tables, dicts: Dictionaries, params: Params, folder: str, checkpoint: str,
    max_files: int = 1000,
) -> StreamingQuery:
    """Load all files that are new since the last start, then stop.

    Each micro-batch becomes a batch of its own, named after ``params.batch_id`` and its number.
    """

    def store(files: DataFrame, number: int) -> None:
        batch = replace(params, batch_id=f"{params.batch_id}_{number:06d}")
        ingest(tables, batch, folder, "resume", files=files)
        ods_to_stage(tables, dicts, batch)

    writer = stream_files(tables.spark, folder, max_files).writeStream.foreachBatch(store)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
