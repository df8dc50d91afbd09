"""Valid and invalid rows of a batch to their own tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as G, schemas


def _part_columns(stage: DataFrame, **changed) -> DataFrame:
    columns = {n: F.col(n) for n in schemas.PART.fieldNames() if n != "id"}
    columns["id"] = F.col("stage_id")
    columns["patent_name"] = F.coalesce(G.blank_to_null(F.col("patent_name")), F.lit(""))
    for name in ("patent_type", "legal_status", "legal_detail_status"):
        columns[name] = G.blank_to_null(F.col(name))
    columns.update(changed)
    return stage.select(*[columns[n].alias(n) for n in schemas.PART.fieldNames()])


def _scope(stage: DataFrame, flag: int, batch_id: str | None, min_key: int | None) -> DataFrame:
    rows = stage.where(F.col("is_valid") == flag)
    if batch_id is not None:
        rows = rows.where(F.col("batch_id") == batch_id)
    if min_key is not None:
        rows = rows.where(F.col("stage_id") > min_key)
    return rows


def split_valid(
    stage: DataFrame, batch_id: str | None = None, min_key: int | None = None
) -> DataFrame:
    """Valid rows with an id; file sizes in megabytes."""
    rows = _scope(stage, 1, batch_id, min_key).where(~G.is_blank(F.col("patent_id")))
    return _part_columns(rows, file_size=G.megabytes(F.col("file_size")))


def split_invalid(
    stage: DataFrame, batch_id: str | None = None, min_key: int | None = None
) -> DataFrame:
    """Invalid rows with their reasons; file sizes stay in bytes."""
    return _part_columns(_scope(stage, 0, batch_id, min_key))


def is_routed() -> Column:
    """Whether a row of Stage goes to one of the two tables."""
    valid = (F.col("is_valid") == 1) & ~G.is_blank(F.col("patent_id"))
    return F.coalesce(valid | (F.col("is_valid") == 0), F.lit(False))
