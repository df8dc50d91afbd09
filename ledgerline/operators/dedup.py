"""Repeated keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from .. import constants as C
from ..functions import append_reason, is_blank
from ..sources.scratch import written
from .joins import MAX_BROADCAST_BYTES, fits_broadcast, hot_split_join

# Ids of a block, as a power of two, and the bytes that hold a bit for each.
BLOCK_BITS = 11
BLOCK_BYTES = (1 << BLOCK_BITS) // 8


def fold_key(c: Column) -> Column:
    """Key that ignores case, accents and trailing spaces."""
    return F.collate(c, C.KEY_COLLATION)


def is_plain(c: Column) -> Column:
    """Whether text is printable ASCII, of which ``fold_plain`` tells the same keys apart as ``fold_key``."""
    return c.rlike("^[ -~]*\\z")


def fold_plain(c: Column) -> Column:
    return F.lower(F.rtrim(F.collate(c, "UTF8_BINARY")))


def repeated_keys(
    stage: DataFrame,
    *,
    key: str = "patent_id",
    order: str = "stage_id",
    scope: list[str] | None = None,
    include_blank: bool = False,
) -> DataFrame:
    """Keys that valid rows hold more than once: ``scope``, ``_key``, lowest ``order``, count."""
    found = key_counts(stage, key=key, order=order, scope=scope, include_blank=include_blank)
    return found.where("cnt > 1")


def key_counts(
    stage: DataFrame,
    *,
    key: str = "patent_id",
    order: str = "stage_id",
    scope: list[str] | None = None,
    include_blank: bool = False,
) -> DataFrame:
    """All keys of valid rows: ``scope``, ``_key``, lowest ``order``, count.

    A plain aggregate: Spark merges repeats before the shuffle, so a hot key is no hot spot, and
    blank keys are left out before any hashing.
    """
    scope = ["batch_id"] if scope is None else scope
    candidates = stage.where(F.col("is_valid") == 1)
    candidates = candidates.where(
        F.col(key).isNotNull() if include_blank else ~is_blank(F.col(key))
    )
    return _counted(candidates.withColumn("_key", fold_key(F.col(key))), scope, order)


def _counted(keyed: DataFrame, scope: list[str], order: str) -> DataFrame:
    return keyed.groupBy(*scope, "_key").agg(
        F.min(order).alias("keep_id"), F.count(F.lit(1)).alias("cnt")
    )


def plain_key(keys: DataFrame) -> DataFrame:
    """Keys as they can be stored; one spelling stands for all of a key."""
    return keys.withColumn("_key", F.collate("_key", "UTF8_BINARY"))


def keys_to_flag(keys: DataFrame, earlier: DataFrame, scope: list[str]) -> DataFrame:
    """Stored keys of new rows that are repeated, among themselves or with ``earlier`` rows, with the
    lowest id of all. Only keys are joined, not rows; earlier loads may each hold a key."""
    folded = fold_key(F.col("_key"))
    first = earlier.groupBy(*scope, folded.alias("_fold")).agg(F.min("keep_id").alias("_before"))
    found = keys.withColumn("_fold", folded).join(first, [*scope, "_fold"], "left")
    found = found.where(F.col("_before").isNotNull() | (F.col("cnt") > 1))
    return found.select(*scope, "_key", F.least("keep_id", "_before").alias("keep_id"), "cnt")


def flag_duplicates(
    stage: DataFrame,
    *,
    key: str = "patent_id",
    order: str = "stage_id",
    reason: str = C.REASON_DUPLICATE,
    scope: list[str] | None = None,
    include_blank: bool = False,
    run_ts: datetime | None = None,
    small: bool | None = None,
    keep: DataFrame | None = None,
    **split,
) -> DataFrame:
    """Among valid rows of a batch with the same key keep the lowest id; mark the others.

    Nothing is removed: a repeated row gets ``is_valid = 0`` and one more reason, and with
    ``run_ts`` a new ``updated_date``.

    The repeated keys are found first, from the key columns alone, and written, so that their
    size is known. Where all keys are plain, as is counted on the way, they are compared as folded text: Spark
    works out a collation key again for each comparison, and the tasks of an executor wait for each other in
    that. If the repeated keys are few, as in most batches, they are broadcast. Otherwise only the key columns
    are joined with them, by a join that splits off hot keys, and what is broadcast is a bit for each id
    (``_marks``). The wide rows are shuffled only if these bits are too many as well. ``keep`` gives the
    keys, where they are known (``keys_to_flag``).
    """
    scope = ["batch_id"] if scope is None else scope
    has_key = F.col(key).isNotNull() if include_blank else ~is_blank(F.col(key))
    has_key = (F.col("is_valid") == 1) & has_key
    narrow = stage.where(has_key).select(
        *[c for c in scope if c != order], F.col(key).alias("_text"), F.col(order)
    )
    fold = fold_key
    if keep is None:
        narrow = written(narrow, "key-columns")
        if small is None and narrow.where(~is_plain(F.col("_text"))).isEmpty():
            fold = fold_plain
        keep = _counted(narrow.withColumn("_key", fold(F.col("_text"))), scope, order)
        keep = plain_key(keep.where("cnt > 1"))
    keep = written(keep, "repeated-keys")
    keep_by_key = keep.withColumn("_key", fold(F.col("_key")))
    if small is None:
        small = fits_broadcast(keep)
        marks = None
        if not small:
            keys = narrow.withColumn("_key", fold(F.col("_text"))).drop("_text")
            marks = _marks(keys, keep_by_key, scope, order, **split)
        if marks is not None:
            at = stage.withColumn("_block", _block(F.col(order)))
            joined = at.join(F.broadcast(marks), [*scope, "_block"], "left")
            repeated = has_key & F.coalesce(_bit(F.col("_bits"), F.col(order)), F.lit(False))
            return mark_invalid(joined, repeated, reason, run_ts).select(*stage.columns)
    keyed = stage.withColumn("_key", F.when(has_key, fold(F.col(key))))
    if small:
        joined = keyed.join(F.broadcast(keep_by_key), [*scope, "_key"], "left")
    else:
        joined = hot_split_join(keyed, keep_by_key, [*scope, "_key"], "cnt", [order], **split)
    repeated = F.col("keep_id").isNotNull() & (F.col(order) != F.col("keep_id"))
    return mark_invalid(joined, repeated, reason, run_ts).select(*stage.columns)


def _block(number: Column) -> Column:
    return F.shiftright(number.cast("bigint"), BLOCK_BITS)


def _bit(bits: Column, number: Column) -> Column:
    """Whether the bit of ``number`` is set among the bits of its block."""
    place = _place(number)
    byte = F.substring(bits, F.shiftright(place, 3) + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), place.bitwiseAND(7)) == 1


def _place(number: Column) -> Column:
    return number.cast("bigint").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int")


def _marks(
    keys: DataFrame, keep: DataFrame, scope: list[str], order: str, **split
) -> DataFrame | None:
    """A bit for each id of a scope: whether its row repeats the key of a lower one. One row for each block
    of ids that has such a row; None if ids are no whole numbers, or lie so far apart that the blocks are too
    many to broadcast. Ids that rows of a scope share have to belong to the same key."""
    if not isinstance(keys.schema[order].dataType, IntegralType):
        return None
    found = hot_split_join(keys, keep, [*scope, "_key"], "cnt", [order], **split)
    found = found.where(F.col(order) != F.col("keep_id"))
    found = written(
        found.select(*scope, _block(F.col(order)).alias("_block"), _place(F.col(order)).alias("_at")),
        "repeated-ids",
    )
    blocks = found.select(*scope, "_block").distinct()
    if blocks.count() > MAX_BROADCAST_BYTES // BLOCK_BYTES:
        return None
    # The aggregate has room for 32,768 bits; a block is the front of it, as each row gets a copy.
    bits = F.substring(F.bitmap_construct_agg("_at"), 1, BLOCK_BYTES)
    return written(found.groupBy(*scope, "_block").agg(bits.alias("_bits")), "repeated-marks")


def mark_invalid(
    df: DataFrame, condition: Column, reason: str, run_ts: datetime | None = None
) -> DataFrame:
    new = {
        "invalid_reason": append_reason(F.col("invalid_reason"), reason),
        "is_valid": F.lit(0),
    }
    if run_ts is not None:
        new["updated_date"] = F.lit(run_ts)
    return df.withColumns(
        {n: F.when(condition, value).otherwise(F.col(n)) for n, value in new.items()}
    )


def keep_first(
    df: DataFrame, key: str, order: list[str], small: bool | None = None, **split
) -> DataFrame:
    """One row per non-NULL key, the first in ``order``; ``order`` must tell the rows apart.

    The wide rows are not grouped: only (key, order) is aggregated, and the keys that occur more
    than once, hardly any, are joined back as in ``flag_duplicates``.
    """
    # A single number fits a hash aggregate; a struct needs a sort.
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    first = (
        df.groupBy(key)
        .agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .where(F.col(key).isNotNull())
    )
    first = written(first, "repeated-keys")
    small = fits_broadcast(first) if small is None else small
    if small:
        joined = df.join(F.broadcast(first), key, "left")
    else:
        joined = hot_split_join(df, first, [key], "_n", order, **split)
    keep = F.col("_first").isNull() | (F.col("_first") == place)
    return joined.where(keep).select(*df.columns)
