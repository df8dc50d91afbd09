"""Joins that hold when one key owns a large share of the rows.

A side is broadcast only if its size is measured (``fits_broadcast``) or limited by the plan
itself (``hot_split_join``). Beyond that size the rows are shuffled and no key, also no NULL key,
is left to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 64
HOT_KEYS = 10_000
HOT_ROWS = 100_000


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure a lookup table; reads at most ``max_rows + 1`` rows of it."""
    width = F.octet_length(F.to_json(F.struct("*")))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def _spread(columns: list[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: Column,
    lookup_key: Column,
    *,
    small: bool,
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join facts to a lookup table; repeated lookup keys multiply rows.

    ``small`` is the result of ``fits_broadcast``. A larger lookup is copied once per salt and the
    facts are spread over the salts by a hash of the whole row, so a hot key becomes ``salts``
    parts. The hash is a function of the row, so a repeated task gives the same parts.
    """
    if small:
        return facts.join(F.broadcast(lookup), fact_key == lookup_key, how)
    salted = facts.withColumn("_salt", _spread(facts.columns, salts))
    copies = lookup.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = (fact_key == lookup_key) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, on, how).drop("_salt", "_copy")


def matching(facts: DataFrame, keys: DataFrame, *, small: bool, how: str = "left_semi"):
    """Rows whose key columns are (``left_semi``) or are not (``left_anti``) in ``keys``.

    ``keys`` holds only key columns named as in ``facts``. Set membership of any list size.
    """
    names = keys.columns
    if small:
        return facts.join(F.broadcast(keys), names, how)
    salted = facts.withColumn("_salt", _spread(facts.columns, SALTS))
    copies = keys.distinct().withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    return salted.join(copies, names + ["_salt"], how).drop("_salt")


def hot_split_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    *,
    hot_keys: int = HOT_KEYS,
    hot_rows: int = HOT_ROWS,
    salts: int = 4096,
) -> DataFrame:
    """Left join to a lookup with unique keys that knows how many facts each key has (``weight``).

    The ``hot_keys`` heaviest keys are broadcast, which bounds the broadcast whatever the data.
    All other keys go through one shuffle; each of them has at most ``1 / hot_keys`` of the
    facts. Rows already served, and rows without a key, are spread over ``salts`` places of that
    shuffle. ``weight`` and ``keys`` are not part of the added columns.
    """
    values = [c for c in lookup.columns if c not in keys and c != weight]
    hot = (
        lookup.where(F.col(weight) >= hot_rows)
        .orderBy(F.desc(weight))
        .limit(hot_keys)
        .select(*keys, F.struct(*values).alias("_hot"))
    )
    # Always 0, but not a literal: a literal would be folded out of the join keys, and the rows
    # spread by ``_place`` would fall together again.
    zero = F.pmod(F.col(weight), F.lit(1)).cast("int")
    cold = lookup.select(*keys, zero.alias("_place"), F.struct(*values).alias("_cold"))
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    place = F.when(F.col("_hot").isNull() & has_key, 0).otherwise(1 + _spread(spread_by, salts))
    return (
        facts.join(F.broadcast(hot), keys, "left")
        .withColumn("_place", place)
        .join(cold, [*keys, "_place"], "left")
        .withColumn("_found", F.coalesce("_hot", "_cold"))
        .select(*facts.columns, *[F.col("_found")[v].alias(v) for v in values])
    )
