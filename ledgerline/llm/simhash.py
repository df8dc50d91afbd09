"""SimHash near-duplicates by exact tiled comparison.

Fingerprints are put into tiles by the population counts of their four 16-bit parts. Two
fingerprints within ``radius`` bits have counts that differ by at most ``radius`` in all, so tile
pairs beyond that are skipped without loss. The tile pairs that are left are compared in numpy:
exclusive-or and bit counts of blocks of bounded size, dealt over the executors. A block pair
gives a spanning forest of its links, never all pairs, so a dense group cannot blow up the result;
no link between different fingerprints is lost for the components.

A null or empty text has fingerprint zero and is linked like any other. Repeated rows and equal
texts share a fingerprint, hence a component. A null id counts for nothing as the smallest id; a
component of null ids only has a null id. An empty table gives an empty result. Only the named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from ..operators.joins import fits_broadcast, matching
from ..sources.scratch import written
from .batches import bounded
from .graph import components
from .words import column, whole

RADIUS = 2
SHINGLE = 3
SEED = 42
PARTS, PART_BITS = 4, 16
BLOCK = 8192
CHUNK = 512


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """64-bit SimHash as a signed number; words are runs of bytes other than ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        spans = zip(starts[: -size + 1].tolist(), ends[size - 1 :].tolist())
    else:
        spans = [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprint_column(text) -> Column:
    return F.pandas_udf(_fingerprints, LongType())(text)


def spanning_links(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between two sets of different fingerprints, which
    may be the same set. Memory is bounded by ``CHUNK`` rows of the comparison."""
    nodes = np.unique(np.concatenate((a, b)))
    ia, ib = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    ua, ub = a.view(np.uint64), b.view(np.uint64)
    root = np.arange(len(nodes))

    def find(x):
        r = root[x]
        while True:
            up = root[r]
            if np.array_equal(up, r):
                root[x] = r
                return r
            r = up

    edges = []
    for at in range(0, len(a), CHUNK):
        near = np.bitwise_count(ua[at : at + CHUNK, None] ^ ub[None, :]) <= radius
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            linked = np.concatenate((ib[near[i]], ia[at + i : at + i + 1]))
            roots = np.unique(find(linked))
            if len(roots) > 1:
                root[roots[1:]] = roots[0]
                edges += [(int(nodes[roots[0]]), int(nodes[r])) for r in roots[1:]]
    return edges


def _compare(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        edges = []
        for a, b in zip(batch["a"], batch["b"]):
            edges += spanning_links(np.asarray(a, np.int64), np.asarray(b, np.int64), radius)
        yield pd.DataFrame(
            np.array(edges, np.int64).reshape(-1, 2), columns=["src", "dst"]
        )


def _part_counts(column: str):
    parts = [
        F.bit_count(F.shiftrightunsigned(column, PART_BITS * p).bitwiseAND(F.lit((1 << PART_BITS) - 1)))
        for p in range(PARTS)
    ]
    code = parts[0]
    for p in parts[1:]:
        code = code * 32 + p
    return code.cast("int")


def _near_offsets(radius: int) -> list[int]:
    """Code differences of tiles whose part counts differ by at most ``radius`` in all."""
    steps = [()]
    for _ in range(PARTS):
        steps = [(*s, d) for s in steps for d in range(-radius, radius + 1)]
    near = [s for s in steps if sum(map(abs, s)) <= radius]
    return sorted({sum(d * 32 ** (PARTS - 1 - i) for i, d in enumerate(s)) for s in near})


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``(src, dst)`` that connect what the pairs within ``radius`` bits connect.

    ``prints`` has different fingerprints in ``print``. Parts of 16 bits have counts of 0 to 16,
    so five bits hold one and a difference of codes below is no other tile's by overflow.
    """
    tiled = prints.select("print", _part_counts("print").alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    # There are at most 17 ** 4 tiles, whatever the data, so their sizes can be broadcast.
    sizes = written(
        sizes.select("tile", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "tiles"
    )
    dealt = tiled.join(F.broadcast(sizes), "tile").select(
        "tile", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int").alias("block"), "print"
    )
    packed = written(
        dealt.groupBy("tile", "block").agg(F.collect_list("print").alias("prints")), "blocks"
    )
    offsets = F.array(*(F.lit(d) for d in _near_offsets(radius) if d >= 0))
    one = sizes.select(F.col("tile").alias("ta"), F.col("blocks").alias("na"), F.explode(offsets).alias("d"))
    other = sizes.select(F.col("tile").alias("tb"), F.col("blocks").alias("nb"))
    pairs = (
        one.select("ta", "na", (F.col("ta") + F.col("d")).alias("tb"))
        .join(F.broadcast(other), "tb")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("ba"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("bb"))
        .where((F.col("ta") != F.col("tb")) | (F.col("ba") <= F.col("bb")))
        .select("ta", "ba", "tb", "bb")
    )
    left = packed.select(F.col("tile").alias("ta"), F.col("block").alias("ba"), F.col("prints").alias("a"))
    right = packed.select(F.col("tile").alias("tb"), F.col("block").alias("bb"), F.col("prints").alias("b"))
    work = pairs.join(left, ["ta", "ba"]).join(right, ["tb", "bb"]).select("a", "b")
    return work.mapInPandas(lambda it: _compare(it, radius), "src bigint, dst bigint").distinct()


def _key(doc_id: str, text: str):
    """Tells rows apart: equal for rows of one id and one text."""
    ident = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.concat_ws(":", ident, F.hex(F.xxhash64(whole(text))))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``(doc_id, key, print, component_id, first_key)`` for every row of ``docs``; ``first_key``
    is the key of the component's row with the smallest id."""
    bounded(docs.sparkSession)
    marked = docs.select(
        F.col(doc_id).alias("doc_id"),
        _key(doc_id, text).alias("key"),
        fingerprint_column(whole(text)).alias("print"),
    )
    marked = written(marked, "prints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    groups = written(marked.groupBy("print").agg(F.min(order).alias("first")), "print-groups")
    label = components(links(groups.select("print"), radius), "src", "dst")
    members = groups.join(label, groups["print"] == label["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("component")
    )
    first = members.groupBy("component").agg(F.min("first").alias("least"))
    ids = members.join(first, "component").select(
        F.col("print").alias("own"),
        F.col("least.doc_id").alias("component_id"),
        F.col("least.key").alias("first_key"),
    )
    found = marked.join(ids, F.col("print") == F.col("own"))
    return found.select("doc_id", "key", "print", "component_id", "first_key")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with its columns as they are: that of the smallest id, rows
    without an id last. Of repeated rows one stays."""
    found = written(near_duplicates(docs, doc_id, text).select("key", "first_key"), "near")
    gone = found.where(F.col("key") != F.col("first_key")).select("key").distinct()
    twice = (
        found.where(F.col("key") == F.col("first_key"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    )
    names = {f"in_{i}": c for i, c in enumerate(docs.columns)}
    rows = docs.select(*(column(c).alias(k) for k, c in names.items()), _key(doc_id, text).alias("key"))
    left = matching(rows, gone, small=fits_broadcast(gone), how="left_anti")
    if not twice.isEmpty():
        small = fits_broadcast(twice)
        repeated = matching(left, twice, small=small, how="left_semi").dropDuplicates(["key"])
        left = matching(left, twice, small=small, how="left_anti").unionByName(repeated)
    return left.select(*(F.col(k).alias(c) for k, c in names.items()))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
