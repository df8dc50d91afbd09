"""Row numbers and ids without a window over a whole table or a whole file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.scratch import written
from .joins import fits_broadcast, hot_split_join

BLOCK = 1 << 16


def number_rows(
    df: DataFrame,
    groups: list[str],
    seq: str,
    out: str,
    *,
    ties: list[str] | None = None,
    total: str | None = None,
    start: int = 0,
    block: int = BLOCK,
    dense: bool = True,
) -> DataFrame:
    """Number rows 1, 2, ... within each group in the order of ``seq`` (an integer column).

    ``total`` names a second number that runs on over all groups, in group order, after ``start``.

    Each group is cut into ranges of ``block`` consecutive values of ``seq``, so a task sorts at
    most ``block`` rows (times the repeats of a value) however large the group is. Only the count
    per range is summed up over ranges; that table has one row per ``block`` input rows. The
    counts are joined back on the partitioning that the sort already has: one shuffle in all.

    Where values of ``seq`` lie far apart, as hashes do, a range holds hardly a row, and the counts are as
    many as the rows. With ``dense`` off they are summed up over three levels of ``block`` ranges each, so that
    no task sorts more than ``block`` counts whatever the 64-bit values are.
    """
    ranged = df.withColumn("_range", F.floor(F.col(seq) / F.lit(block)))
    place = [*groups, "_range"]
    in_group = Window.partitionBy(*groups).orderBy("_range")
    before = ranged.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    added = ["_before", "_base"] if total else ["_before"]
    if dense:
        before = before.withColumn("_before", F.sum("_n").over(in_group) - F.col("_n"))
        if total:
            overall = Window.orderBy(*place)
            before = before.withColumn("_base", F.sum("_n").over(overall) - F.col("_n"))
    else:
        before = _summed_by_levels(before, groups, block)
        if total:
            sizes = before.groupBy(*groups).agg(F.sum("_n").alias("_size"))
            overall = Window.orderBy(*groups)
            sizes = sizes.withColumn("_base", F.sum("_size").over(overall) - F.col("_size")).drop("_size")
            before = before.join(sizes, groups).withColumn("_base", F.col("_base") + F.col("_before"))
    order = Window.partitionBy(*place).orderBy(seq, *(ties or []))
    numbered = ranged.withColumn("_in_range", F.row_number().over(order)).join(
        before.select(*place, *added), place
    )
    names = df.columns
    result = [F.col(c) for c in names]
    in_range = F.col("_in_range")
    result.append((F.col("_before") + in_range).cast("bigint").alias(out))
    if total:
        result.append((F.lit(start) + F.col("_base") + in_range).cast("bigint").alias(total))
    return numbered.select(*result)


def _summed_by_levels(counts: DataFrame, groups: list[str], block: int) -> DataFrame:
    """Adds ``_before``, the sum of ``_n`` over the earlier ranges of the group.

    Ranges are put together by ``block``, these again, and the sums of each level are taken within the
    next one only.
    """
    levels = [written(counts, "range-counts")]
    for k in (1, 2):
        finer = "_range" if k == 1 else f"_level_{k - 1}"
        coarse = F.floor(F.col(finer) / F.lit(block)).alias(f"_level_{k}")
        levels[-1] = levels[-1].select("*", coarse)
        levels.append(levels[-1].groupBy(*groups, f"_level_{k}").agg(F.sum("_n").alias("_n")))
    found = None
    for k in (2, 1, 0):
        at = f"_level_{k}" if k else "_range"
        within = [*groups, f"_level_{k + 1}"] if k < 2 else groups
        running = Window.partitionBy(*within).orderBy(at)
        level = levels[k].withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
        if found is not None:
            level = level.join(found.select(*within, F.col("_before").alias("_earlier")), within)
            level = level.withColumn("_before", F.col("_before") + F.col("_earlier")).drop("_earlier")
        found = level
    return found.select(*counts.columns, "_before")


def assign_ids(
    rows: DataFrame,
    sizes: DataFrame,
    file_keys: list[str],
    *,
    row: str = "_row_num",
    count: str = "rows_loaded",
    out: str = "stage_id",
    start: int = 0,
) -> DataFrame:
    """Dense ids after ``start`` in (file, row) order, for rows numbered 1..n in every file.

    ``sizes`` is the file log: one row per file with its count. The id of a row is the number of
    rows in earlier files plus its own row number, so the data is neither sorted nor shuffled.
    Running sums are taken over the log only. A log too long to broadcast is joined with its
    largest files split off.
    """
    ordered = Window.orderBy(*file_keys)
    offsets = sizes.select(
        *file_keys,
        F.col(count).alias("_size"),
        (F.lit(start) + F.sum(count).over(ordered) - F.col(count)).cast("bigint").alias("_base"),
    )
    if fits_broadcast(offsets):
        placed = rows.join(F.broadcast(offsets.drop("_size")), file_keys)
    else:
        placed = hot_split_join(rows, offsets, file_keys, "_size", [*file_keys, row])
    return placed.select(
        (F.col("_base") + F.col(row)).cast("bigint").alias(out), *[F.col(c) for c in rows.columns]
    )


def max_key(df: DataFrame, key: str) -> int:
    """Highest key of a table, 0 if it is empty."""
    return df.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]


def min_key(df: DataFrame, key: str) -> int | None:
    """Lowest key of a table: where open work starts."""
    return df.agg(F.min(key)).first()[0]


def lowest_keys(df: DataFrame, key: str, by: list[str], out: str) -> DataFrame:
    """Lowest key per group: where open work starts in each."""
    return df.groupBy(*by).agg(F.min(key).alias(out))


def shift_ids(df: DataFrame, key: str, offset: int, old_max: int) -> DataFrame:
    """Move the ids up to ``old_max`` by ``offset``; ids above it were moved before."""
    moved = F.when(F.col(key) <= old_max, F.col(key) + offset).otherwise(F.col(key))
    return df.withColumn(key, moved.cast("bigint"))


def shift_bounds(previous: DataFrame, current: DataFrame, key: str = "stage_id"):
    """(offset, highest id not yet moved) for placing ``current`` behind ``previous``.

    A moved id is above the offset, so all ids up to it were not moved yet. Raises if ``previous``
    is empty, and if ``current`` has ids on both sides of the offset: a shift is one whole
    rewrite, so that means the id ranges overlap.
    """
    offset = max_key(previous, key)
    if offset <= 0:
        raise ValueError("the table in front is empty: there is no offset to shift by")
    waiting = F.when(F.col(key) <= offset, F.col(key))
    old_max, moved = current.agg(
        F.coalesce(F.max(waiting), F.lit(0)), F.count(F.when(F.col(key) > offset, 1))
    ).first()
    if old_max and moved:
        raise ValueError(f"ids lie on both sides of the offset {offset}: the ranges overlap")
    return offset, old_max
