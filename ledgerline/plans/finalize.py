"""Partition tables to the final tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import constants as C, functions as G, schemas
from ..operators.ids import shift_bounds, shift_ids
from ..operators.upsert import insert_ignore, upsert_columns
from ..params import Params


def _with_users(params: Params) -> dict:
    user = F.lit(params.default_user)
    return {n: F.coalesce(F.col(n), user) for n in ("created_by", "updated_by")}


def final_valid(valid: DataFrame, params: Params) -> DataFrame:
    """Rows for the final valid table: those that file checks have left valid."""
    special = {
        "publish_year": F.col("publication_year"),
        "inti_main_type_code": G.type_code(F.col("intci_main_code")),
        "data_source": F.lit(params.data_source),
        **_with_users(params),
    }
    rows = valid.where(F.col("is_valid") == 1)
    return rows.select(
        *[special.get(n, F.col(n)).alias(n) for n in schemas.FINAL_VALID.fieldNames()]
    )


def failed_checks(
    valid: DataFrame, invalid: DataFrame, params: Params, unique: bool = False
) -> DataFrame:
    """Rows that file checks have marked invalid after the split, for the invalid table.

    They stay in the valid table too. An id that is there already is left out. ``unique`` says
    that ids of the valid table do not repeat, which saves a step.
    """
    rows = valid.where(F.col("is_valid") == 0).withColumns(_with_users(params))
    return insert_ignore(rows, invalid, "id", None if unique else ["_source_file", "_row_num"])


def final_invalid(invalid: DataFrame, params: Params) -> DataFrame:
    """Rows for the final invalid table, cut to its column lengths."""
    special = {
        "patent_id": F.coalesce(F.col("patent_id"), F.lit("")),
        "publish_year": F.col("publication_year"),
        "reason": F.col("invalid_reason"),
        "data_source": F.lit(params.data_source),
        **_with_users(params),
    }
    for name, length in C.INVALID_LENGTHS.items():
        special[name] = F.left(F.col(name), F.lit(length))
    return invalid.select(
        *[special.get(n, F.col(n)).alias(n) for n in schemas.FINAL_INVALID.fieldNames()]
    )


def merge_sources(*finals: DataFrame) -> DataFrame:
    """Final rows of several partitions as one table, told apart by ``data_source``."""
    return reduce(DataFrame.unionByName, finals)


def place_behind(
    previous_stage: DataFrame, stage: DataFrame, valid: DataFrame, invalid: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables of a partition with ids behind those of the partition before it."""
    offset, old_max = shift_bounds(previous_stage, stage)
    return (
        shift_ids(stage, "stage_id", offset, old_max),
        shift_ids(valid, "id", offset, old_max),
        shift_ids(invalid, "id", offset, old_max),
    )


def refresh_valid(valid: DataFrame, stage: DataFrame, columns: list[str]) -> DataFrame:
    """Bring corrected Stage columns of valid rows over to the valid table, also NULLs."""
    patch = stage.where(F.col("is_valid") == 1).select(F.col("stage_id").alias("id"), *columns)
    return upsert_columns(valid, patch, "id", columns)
