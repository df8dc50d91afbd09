"""The patent-shaped view over orders, customer and nation, and the inline dictionaries."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import in_small_methods
from ..operators.ids import number_rows
from ..params import Params
from ..plans.standardize import standardize
from ..sources.dictionaries import Dictionaries

RAW_TEMPLATE = (Path(__file__).parent / "raw_patents.sql").read_text(encoding="utf-8")
ROWS_TEMPLATE = """
SELECT o.o_orderkey AS k, CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS d, o.o_orderstatus,
  o.o_orderpriority, c.c_name, c.c_mktsegment, c.c_nationkey, n.n_name,
  concat('f', CAST(o.o_orderkey % 10 AS STRING), '.csv') AS file
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey"""

# Invented entries: one switched off, a second dict_code, a match by the second language column
# only, a path base per partition, and no entry for two of the countries in the data.
DICTIONARY_ROWS = {
    "dict_mapping": (
        "source_value, standard_value, dict_code, is_valid",
        "('授权','有效','legal_status',1), ('公开','审中','legal_status',1), "
        "('未知','失效','legal_status',0), ('公开','x','other',1)",
    ),
    "dict_language": (
        "iso639_1, iso639_2, iso639_2_b",
        "('zh','zho','chi'), ('en','eng','eng'), ('fr','fra','fre')",
    ),
    "dict_pid_s3_map": (
        "table_id, pid, s3_path_base, s3_type, bucket_name",
        "('a',101,'bucket/a/','s3','pat-a'), ('d',104,'bucket/d/','s3','pat-d')",
    ),
    "dict_country": (
        "country_code, country_name_cn",
        "('CN','中国'), ('US','美国'), ('HK','中国香港'), ('TW','中国台湾'), "
        "('WO','世界知识产权组织')",
    ),
}

PARAMS = Params(table_id="a", batch_id="batch_1", ods_table="ods_patents", data_source="A")

_dictionaries: dict[str, Dictionaries] = {}


# Columns in use. A given schema saves reading file footers to find it.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def dictionaries(spark: SparkSession) -> Dictionaries:
    """Inline dictionaries; their measured sizes are kept for the session."""
    session = spark.sparkContext.applicationId
    if session not in _dictionaries:
        frames = [
            spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")
            for columns, rows in DICTIONARY_ROWS.values()
        ]
        _dictionaries[session] = Dictionaries(*frames)
    return _dictionaries[session]


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ROWS_TEMPLATE, **{n: table(spark, sf_dir, n) for n in TABLES})


def _patents(spark: SparkSession, rows: DataFrame, numbers: str) -> DataFrame:
    return in_small_methods(spark.sql(RAW_TEMPLATE.replace("{numbers}", numbers), rows=rows), "title")


def unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view without row numbers, for rules that look at one row at a time."""
    return _patents(spark, _rows(spark, sf_dir), "k AS _seq").drop("_seq")


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with ``k``, the order of its rows."""
    return _patents(spark, _rows(spark, sf_dir), "k")


def raw(spark: SparkSession, sf_dir: str, total: str | None = None) -> DataFrame:
    """Raw rows as loaded, numbered within their file and, as ``total``, over all files.

    The few source columns are numbered before the 35 columns are made from them, so that the
    shuffle moves as little as possible.
    """
    rows = number_rows(_rows(spark, sf_dir), ["file"], "k", "_row_num", total=total)
    return _patents(spark, rows, ", ".join(["_row_num"] + ([total] if total else [])))


def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a file log would hold: rows per batch and file."""
    rows = unnumbered(spark, sf_dir).groupBy("batch_id", "_source_file")
    return rows.agg(F.count(F.lit(1)).alias("rows_loaded"))


def stage(spark: SparkSession, sf_dir: str, params: Params = PARAMS) -> DataFrame:
    """Standardised rows with ids in (file, row) order."""
    return standardize(raw(spark, sf_dir, "stage_id"), dictionaries(spark), params)


def without_run_times(df: DataFrame) -> DataFrame:
    return df.drop("created_date", "updated_date")
