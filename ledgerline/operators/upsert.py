"""Updates and inserts by key, written as joins over immutable tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import written
from .dedup import keep_first
from .joins import fits_broadcast, matching


def upsert_columns(
    target: DataFrame, patch: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """Overwrite ``columns`` of the target rows whose key is in ``patch``, also with NULL.

    ``patch`` holds ``key`` (unique) and ``columns``.
    """
    new = patch.select(key, F.struct(*columns).alias("_new"))
    joined = target.join(new, key, "left")
    hit = F.col("_new").isNotNull()
    return joined.withColumns(
        {c: F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) for c in columns}
    ).select(*target.columns)


def insert_ignore(
    new: DataFrame, existing: DataFrame, key: str, order: list[str] | None = None
) -> DataFrame:
    """The rows of ``new`` whose key is not in ``existing`` yet, ready to append.

    With ``order`` repeated keys within ``new`` are cut down to the first. Leave it out where the
    key is known to be unique: it costs an aggregate and a join.

    The keys alone are joined first, and those of ``new`` that are there already are written: none, in
    most runs, or few, so the wide rows are not shuffled.
    """
    if order:
        new = keep_first(new, key, order)
    known = existing.select(key)
    found = written(new.select(key).join(known, key, "left_semi"), "known-keys")
    if found.isEmpty():
        return new
    if fits_broadcast(found):
        known = F.broadcast(found)
    return new.join(known, key, "left_anti")


def key_window(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` cut to the key range of ``new``: sorted files outside it are not read."""
    low, high = new.agg(F.min(key), F.max(key)).first()
    return existing.where(F.col(key).between(low, high)) if low is not None else existing.limit(0)


def upsert_rows(
    existing: DataFrame, new: DataFrame, keys: list[str], *, created="created_at",
    updated="updated_at",
) -> DataFrame:
    """Latest row per key; ``created`` stays that of the first row.

    One aggregate with partial merging; ``new`` wins over ``existing``.
    """
    both = existing.withColumn("_turn", F.lit(0)).unionByName(new.withColumn("_turn", F.lit(1)))
    others = [c for c in existing.columns if c not in keys and c != created]
    latest = F.max_by(F.struct(*others), F.struct("_turn", updated)).alias("_latest")
    return (
        both.groupBy(*keys)
        .agg(latest, F.min(created).alias(created))
        .select(
            *[
                F.col(c) if c in keys or c == created else F.col("_latest")[c].alias(c)
                for c in existing.columns
            ]
        )
    )


def delete_files(
    stage: DataFrame, files: DataFrame, file_keys: tuple[str, str] = ("batch_id", "_source_file")
) -> DataFrame:
    """Rows left after all rows of the named files are taken out (before a second load)."""
    keys = files.select(*file_keys).distinct()
    return matching(stage, keys, small=fits_broadcast(keys), how="left_anti")
