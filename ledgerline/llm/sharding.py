"""Shards by balanced label propagation.

Linked documents move to the shard in which most of their neighbours stand, under quotas that keep
the shards even. Links are given by a key: rows of one key are linked with each other, here rows of
equal text. A key stands for all pairs of its rows, so no pair is ever made.

A key that is larger than a shard is cut into parts of nearly a shard's size; a part, or a key that
needs no cut, is a group. As long as a group has no label its rows stand where a hash puts them. In
each round, a group without a label asks for the shard that holds most of its rows among those that
still have room for all of it; a shard lets groups in, larger ones first, up to its quota, and
passes over those that do not fit. Rounds go on until none is let in, so the cut no longer falls.
Rows without links and groups that fit nowhere as a whole then fill what is left of each quota, so
that the counts of rows differ by one at most (law ``rows``).

Rounds work on a table of groups with counts by shard; the rows are joined to it once, and groups of
very many rows are broadcast for that (their number is bounded). Which row of a key that is cut goes
to which part depends on the place of the row in its files.

A null text has size 1 and is linked with empty texts. Null ids and repeated rows are rows like any
other. An empty table gives an empty result. Only the named columns are read, so other columns may
have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import HOT_ROWS, hot_split_join
from ..sources.scratch import written
from .words import whole

SHARDS = 16
BUCKETS = 4096
ASKING = 256
FILL = 0.9


def _bucket(*columns, buckets: int = BUCKETS) -> Column:
    """Place of a row within an order by hash; the same in every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def _targets(rows: DataFrame, shards: int) -> list[tuple[int, int, int]]:
    """Shard, rows now and rows wanted: at most one apart; the fuller ones get the extra rows."""
    now = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("has"))
    has = {r["shard"]: r["has"] for r in now.collect()}  # at most one row per shard
    total = sum(has.values())
    fullest = sorted(range(shards), key=lambda s: (-has.get(s, 0), s))
    wanted = {s: total // shards + (i < total % shards) for i, s in enumerate(fullest)}
    sizes = [(s, has.get(s, 0), wanted[s]) for s in range(shards)]
    return sizes


def _grouped(rows: DataFrame, quota: int, hot_rows: int) -> DataFrame:
    """Adds ``linked``, the number of rows of the key, and ``unit``, the group of the row; a row
    that is alone has none."""
    linked = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    linked = written(linked.withColumn("linked", F.col("n")), "shard-keys")
    rows = hot_split_join(rows, linked, ["key"], "n", ["doc_id", "row"], hot_rows=hot_rows)
    parts = F.ceil(F.col("linked") / F.lit(max(1.0, FILL * quota))).cast("long")
    part = F.when(F.col("linked") > quota, F.pmod(F.xxhash64("row"), parts)).otherwise(F.lit(0))
    return rows.select(
        *(c for c in rows.columns if c != "linked"),
        F.coalesce("linked", F.lit(1)).alias("linked"),
        F.when(F.col("linked") > 1, F.xxhash64("key", part)).alias("unit"),
    )


def _asking(groups: DataFrame, room: list[int], salt: int) -> DataFrame:
    """Adds the shard ``to`` that a group asks for, null if none has room for it, and the class of
    size and the bucket in which it is let in or not."""
    left = F.array(*(F.lit(r).cast("long") for r in room))
    choices = F.transform(
        "stands",
        lambda there, s: F.struct(
            there.alias("there"),
            F.xxhash64("unit", s, F.lit(salt)).alias("tie"),
            s.alias("shard"),
        ),
    )
    fitting = F.filter(choices, lambda c: F.get(left, c["shard"]) >= F.col("n"))
    return groups.select(
        "*",
        F.array_max(fitting)["shard"].alias("to"),
        F.floor(F.log2("n")).cast("int").alias("class"),
        _bucket("unit", F.lit(salt), buckets=ASKING).alias("bucket"),
    )


def _let_in(asking: DataFrame, room: list[int]) -> list[tuple[int, int, int]]:
    """``(to, class, bucket)`` that fit, larger classes first; takes the room that they need."""
    asked = (
        asking.where("to IS NOT NULL")
        .groupBy("to", "class", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most shards x classes x buckets numbers, whatever the data
    )
    found = []
    for r in sorted(asked, key=lambda r: (-r["class"], r["bucket"], r["to"])):
        if r["n"] <= room[r["to"]]:
            room[r["to"]] -= r["n"]
            found.append((r["to"], r["class"], r["bucket"]))
    return found


def _propagated(groups: DataFrame, shards: int, quota: int) -> DataFrame | None:
    """``(unit, n, label)`` of the groups ``(unit, n, stands)`` that are let in as a whole."""
    spark, room, labels, salt = groups.sparkSession, [quota] * shards, [], 0
    while True:
        asking = _asking(groups, room, salt)
        accepted = _let_in(asking, room)
        if not accepted:
            break
        places = spark.createDataFrame(accepted, "to int, class int, bucket int")
        places = places.withColumn("label", F.col("to"))
        done = asking.join(F.broadcast(places), ["to", "class", "bucket"], "left")
        done = written(done.select("unit", "n", "stands", "label"), "shard-groups")
        labels.append(done.where("label IS NOT NULL").select("unit", "n", "label"))
        groups = done.where("label IS NULL").select("unit", "n", "stands")
        salt += 1
    return reduce(DataFrame.unionAll, labels) if labels else None


def _moved(rows: DataFrame, shards: int, quota: int, hot_rows: int) -> DataFrame:
    """Adds ``held``: the row stands with its whole group, which is within the shard's quota."""
    stands = F.array(*(F.count_if(F.col("shard") == s) for s in range(shards)))
    groups = rows.where("unit IS NOT NULL").groupBy("unit")
    groups = groups.agg(F.count(F.lit(1)).alias("n"), stands.alias("stands"))
    labels = _propagated(written(groups, "shard-groups"), shards, quota)
    if labels is None:
        return rows.withColumn("held", F.lit(False))
    found = hot_split_join(rows, labels, ["unit"], "n", ["doc_id", "row"], hot_rows=hot_rows)
    return found.select(
        *(c for c in rows.columns if c != "shard"),
        F.coalesce("label", "shard").alias("shard"),
        F.col("label").isNotNull().alias("held"),
    )


def _ranked(rows: DataFrame, first: str, name: str) -> DataFrame:
    """Adds the place of each row in its shard, from 0, ordered by ``first`` and a hash of the row.

    Counts per bucket are summed up over at most shards x classes x buckets numbers; only rows of
    one bucket are ordered together.
    """
    # Of a text with very many copies even rows of one id are spread.
    own = _bucket("doc_id", "size", "text_crc32")
    bucket = F.when(F.col("linked") > BUCKETS, _bucket("row")).otherwise(own)
    rows = rows.withColumn("bucket", bucket)
    counts = rows.groupBy("shard", first, "bucket").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("shard").orderBy(first, "bucket")
    before = counts.select(
        "shard", first, "bucket",
        (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    within = Window.partitionBy("shard", first, "bucket").orderBy("doc_id", "text_crc32", "size", "row")
    placed = rows.withColumn("within", F.row_number().over(within) - 1)
    return (
        placed.join(F.broadcast(before), ["shard", first, "bucket"])
        .withColumn(name, F.col("before") + F.col("within"))
        .drop("bucket", "before", "within")
    )


def _evened(rows: DataFrame, shards: int) -> DataFrame:
    """Move exactly the surplus of each shard to where rows are missing: rows without links first,
    then those of groups that fit nowhere; rows that are held stay."""
    spark = rows.sparkSession
    surplus, gaps, at, taken = [], [], 0, 0
    for shard, has, wanted in _targets(rows, shards):
        if has > wanted:
            surplus.append((shard, has - wanted, at))
            at += has - wanted
        elif wanted > has:
            gaps.append((shard, taken, taken + wanted - has))
            taken += wanted - has
    if not surplus:
        return rows
    loose = rows.where("NOT held").withColumn("class", (F.col("linked") > 1).cast("int"))
    over = spark.createDataFrame(surplus, "shard int, extra long, base long")
    ranked = _ranked(loose, "class", "rank").join(F.broadcast(over), "shard", "left")
    place = F.when(F.col("rank") < F.col("extra"), F.col("base") + F.col("rank"))
    # At most one gap per shard, so the choice is an expression instead of a join by range.
    into = F.lit(None).cast("int")
    for shard, low, high in gaps:
        into = F.when((place >= low) & (place < high), F.lit(shard)).otherwise(into)
    ranked = ranked.withColumn("shard", F.coalesce(into, "shard"))
    return rows.where("held").unionByName(ranked.select(*rows.columns))


def balanced_shards(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(doc_id, size, text_crc32, key, shard, slot)`` for every row of ``docs``."""
    body = whole(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    # The start is even by hash of the row.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "key"), F.lit(shards)).cast("int"))
    rows = written(rows, "shard-rows")
    quota = rows.count() // shards
    rows = written(_grouped(rows, quota, hot_rows), "shard-rows")
    rows = written(_moved(rows, shards, quota, hot_rows), "shard-rows")
    rows = written(_evened(rows, shards), "shard-rows")
    return _ranked(rows.withColumn("class", F.lit(0)), "class", "slot").select(
        "doc_id", "size", "text_crc32", "key", "shard", "slot"
    )


def kept_links(found: DataFrame, key: str = "key") -> float:
    """Share of the pairs of equal ``key`` that stand in one shard; 1 if there are no pairs."""
    counts = found.groupBy(key, "shard").agg(F.count(F.lit(1)).cast("double").alias("n"))
    keys = counts.groupBy(key).agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("kept"), F.sum("n").alias("n"))
    kept, pairs = keys.agg(F.sum("kept"), F.sum(F.col("n") * (F.col("n") - 1))).first()
    return kept / pairs if pairs else 1.0


def op3_shards(spark, sf_dir: str) -> DataFrame:
    found = balanced_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
