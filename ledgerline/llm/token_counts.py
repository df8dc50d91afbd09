"""Token counts through a cache keyed by the digests of the content and of the tokenizer.

The content's digest and the tokenizer's version (digest of its file) are joined to the stored
counts. Only digests without a count are encoded, each once, and their counts are appended. The
counts of all rows are then read from the cache.

Counts are those of ``tokenizers`` for the JSON file. ``tiktoken`` gives the same counts in a
quarter of the time where both libraries cut a text alike, which holds for texts of the characters
in ``SAME`` (a test compares both on these); every other text goes to ``tokenizers`` itself.

"Normalised" content is the text as it is, null taken as empty: any other change could change the
count. Null and empty texts have 0 tokens. Repeated rows and null ids each give a row; an empty
table gives an empty result. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import hot_split_join
from ..sources.scratch import scratch_folder
from .batches import bounded
from .words import whole

LIMIT = 512
HOT_ROWS = 1000
END_OF_TEXT = "<|endoftext|>"
# Printable ASCII with line feed and tab, and letters of Latin-1.
SAME = re.compile(r"[\n\t\x20-\x7E\xC0-\xD6\xD8-\xF6\xF8-\xFF]*")


@cache
def _version(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


@cache
def _exact(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _fast(path: str, pattern: str):
    import tiktoken

    lines = Path(path).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {END_OF_TEXT: len(ranks)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


class Counter:
    """Counts tokens in tasks; files are found by name in ``public_tokenizers`` there."""

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers

        self.json = f"{name}.json"
        self.ranks = f"{name}.tiktoken"
        self.version = _version(public_tokenizers.path(self.json))

    def count(self, text: str) -> int:
        import public_tokenizers as public

        if SAME.fullmatch(text):
            fast = _fast(public.path(self.ranks), public.PATTERN)
            try:
                return len(fast.encode(text, allowed_special="all"))
            except ValueError:  # some hundred thousand white-space characters on end are too many for it
                pass
        exact = _exact(public.path(self.json))
        return len(exact.encode_batch_fast([text], add_special_tokens=False)[0])

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [self.count(t) for t in batch["body"]]
            yield pd.DataFrame({"digest": batch["digest"], "n_tokens": counts})


SCHEMA = "digest string, tokenizer string, n_tokens bigint"


def stored(spark, cache_path: str, version: str) -> DataFrame:
    """``(digest, n_tokens)`` of one tokenizer version; a cache that does not exist is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    rows = spark.read.schema(SCHEMA).parquet(cache_path) if there else spark.createDataFrame([], SCHEMA)
    # A run that was broken off after its append can have stored a digest twice.
    rows = rows.where(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append_misses(docs: DataFrame, cache_path: str, text: str, counter: Counter) -> None:
    """Encode every distinct text that the cache lacks, once, and append its count.

    Copies are reduced to one row in each task before the shuffle, so a text that fills a third
    of the table is one row per task there.
    """
    body = whole(text)
    one = docs.select(F.sha2(body, 256).alias("digest"), body.alias("body"))
    one = one.groupBy("digest").agg(F.first("body").alias("body"))
    known = stored(docs.sparkSession, cache_path, counter.version)
    misses = one.join(known, "digest", "left_anti")
    counted = misses.mapInPandas(counter, "digest string, n_tokens bigint")
    counted.select("digest", F.lit(counter.version).alias("tokenizer"), "n_tokens").write.mode(
        "append"
    ).parquet(cache_path)


def token_counts(
    docs: DataFrame,
    cache_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    counter: Counter | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """Bytes and tokens of every row; fills the cache first."""
    counter = counter or Counter()
    bounded(docs.sparkSession)
    append_misses(docs, cache_path, text, counter)
    body = whole(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.sha2(body, 256).alias("digest"),
    )
    counts = stored(docs.sparkSession, cache_path, counter.version)
    # A text that fills a third of the table is no hot key.
    counts = counts.join(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "digest")
    rows = hot_split_join(rows, counts, ["digest"], "n", ["doc_id", "n_bytes"], hot_rows=HOT_ROWS)
    return rows.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so every distinct text is encoded in this run."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, scratch_folder(spark, "token-cache"))
