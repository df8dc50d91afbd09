"""A training corpus from raw documents, in five stages.

Each stage works on all rows that the one before has kept; its result is written as Parquet below
the shared folder and read again as the documents of the next.

For all stages: a null text is an empty one, and both go with the first stage, which wants ten words; a
stage by itself keeps them unless it says otherwise. Texts of any length are taken whole. Repeated rows
are near duplicates of each other; one stays. Rows without an id count as the largest id. Columns of any
name come through all but the last stage, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, quality_rules, secrets, sentencepieces, simhash
from ledgerline.sources.scratch import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go, in a cascade. Empty texts go: they have too few words."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest id; of several rows
    of that id, the one of the smallest hash. Texts without words are one group."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go; texts without words
    stay."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts, also in decoded layers, are replaced by a mark, and ``n_chars`` is counted
    anew. A null text stays null with its count."""
    return secrets.redacted(docs, n_chars="n_chars")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text that is left; none for an empty one."""
    return sentencepieces.encode(docs).select("doc_id", "lang", "source", "ids")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("sentence pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs


#: SimHash, decoded layers and merges have no SQL form; tests/llm/test_pipeline.py compares the rows of
#: every stage with plain Python.
ORACLE_SQL = None
