"""Benchmark decontamination by winnowing.

Both sides keep the least k-gram hash of every ``n - k + 1`` neighbouring k-grams. A shared span of
``n`` words has the same k-grams on both sides, so it shares the least of them: every shared span of
``n`` words has a common fingerprint. Texts that share a fingerprint are looked at again: every
window of ``n`` words around the fingerprint is compared word by word with the windows of the
items, so a hash decides nothing alone. An item of fewer than ``n`` words is one window; such
windows are looked up at every place of the texts, by length.

A null or empty text has no words and no hits. An item without words has no window; windows of
items with a null id count as hits but name no item. Repeated rows and null ids each give a row;
rows of one id and text share their result. Empty tables give empty results or no hits. Only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import MAX_BROADCAST_ROWS, fits_broadcast, matching
from ..sources.scratch import written
from .words import alnum_words, column, whole, window_hashes, window_minima

N_WORDS = 13
K_GRAM = 8


def fingerprints(rows: DataFrame, n: int = N_WORDS, k: int = K_GRAM) -> DataFrame:
    """Adds ``grams`` (hash of every k-gram of ``words``) and ``minima`` (the least of each window)."""
    rows = window_hashes(rows, "words", k, "grams")
    return window_minima(rows, "grams", n - k + 1, "minima")


def _each_print():
    """An expression, not a column, is exploded: of a column Spark would ask first that it is not
    empty, and that test would be computed from the words once more."""
    return F.explode(F.array_distinct("minima")).alias("print")


def windows(items: DataFrame, n: int = N_WORDS) -> DataFrame:
    """``(item, length, phrase)`` for every window of every item (columns ``item``, ``words``)."""
    size = F.size("words")
    length = F.least(size, F.lit(n))
    starts = F.sequence(F.lit(1), size - length + 1)
    return (
        items.where(size > 0)
        .select("item", "words", length.alias("length"), F.explode(starts).alias("start"))
        .select("item", "length", F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("phrase"))
        .distinct()
    )


def _hit_places(texts: DataFrame, items: DataFrame, n: int, k: int, max_rows: int) -> DataFrame:
    """Rows of ``texts`` (``doc``, ``mark``, ``words``) with the places ``at`` (from 0) of k-grams
    whose hash is a fingerprint on both sides. Rows without such a place are left out."""
    prints = (
        fingerprints(items, n, k).select(_each_print()).distinct()
    )
    long = fingerprints(texts, n, k)
    if fits_broadcast(prints, max_rows):
        # The words stay with the row: nothing but the hits leaves the task.
        hits = long.select("doc", "mark", "words", "grams", _each_print()).join(
            F.broadcast(prints), "print", "left_semi"
        )
        at = F.filter(
            F.sequence(F.lit(0), F.size("grams") - 1),
            lambda i: F.get("grams", i) == F.col("print"),
        )
        return hits.select("doc", "mark", "words", at.alias("at"))
    # Too many fingerprints to send to every task: only keys and hashes are shuffled.
    keys = long.select("doc", "mark", _each_print())
    keys = keys.join(prints, "print", "left_semi")
    found = keys.groupBy(F.col("doc").alias("hit_doc"), F.col("mark").alias("hit_mark")).agg(
        F.collect_set("print").alias("found")
    )
    same = F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("mark") == F.col("hit_mark"))
    at = F.filter(
        F.sequence(F.lit(0), F.size("grams") - 1),
        lambda i: F.array_contains("found", F.get("grams", i)),
    )
    return long.join(found, same).select("doc", "mark", "words", at.alias("at"))


def hits(
    texts: DataFrame,
    items: DataFrame,
    n: int = N_WORDS,
    k: int = K_GRAM,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Per ``(doc, mark)`` with a hit: the spans hit and the items whose windows occur."""
    known = windows(items, n)
    lengths = [r[0] for r in known.where(F.col("length") < n).select("length").distinct().collect()]
    # A fingerprint at place p lies in the windows that start at p - (n - k) to p.
    around = F.flatten(
        F.transform("at", lambda p: F.sequence(F.greatest(p - (n - k), F.lit(0)), p))
    )
    fits = F.filter(F.array_distinct(around), lambda s: s + n <= F.size("words"))
    parts = [
        _hit_places(texts, items.where(F.size("words") >= n), n, k, max_rows)
        .select("doc", "mark", "words", F.explode(fits).alias("start"))
        .withColumn("length", F.lit(n))
    ]
    for length in lengths:  # at most n - 1 of them
        starts = F.sequence(F.lit(0), F.size("words") - length)
        parts.append(
            texts.where(F.size("words") >= length)
            .select("doc", "mark", "words", F.explode(starts).alias("start"))
            .withColumn("length", F.lit(length))
        )
    small = fits_broadcast(known, max_rows)
    known = F.broadcast(known) if small else known
    places = None
    for part in parts:
        phrase = F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ")
        part = part.select("doc", "mark", "start", "length", phrase.alias("phrase"))
        part = part.join(known, ["length", "phrase"]).select("doc", "mark", "start", "length", "item")
        places = part if places is None else places.unionAll(part)
    span = F.struct("start", "length")
    return places.groupBy("doc", "mark").agg(
        F.collect_set(span).alias("spans"), F.collect_set("item").alias("items")
    )


def _hit_words(spans):
    """Words inside the union of spans of different lengths."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def add(acc, span):
        end = F.greatest(acc["end"], span["start"] + span["length"])
        new = F.greatest(end - F.greatest(acc["end"], span["start"]), F.lit(0))
        return F.struct(end.alias("end"), (acc["total"] + new).alias("total"))

    return F.aggregate(F.sort_array(spans), begin, add)["total"]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = N_WORDS,
    k: int = K_GRAM,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: words, words hit, items met, and the verdict: contaminated if
    at least a twentieth of the words is hit. ``max_rows`` bounds what is broadcast."""
    body = whole(text)
    texts = docs.select(
        F.col(doc_id).alias("doc"), F.xxhash64(body).alias("mark"), alnum_words(body).alias("words")
    )
    items = benchmark.select(
        F.col(item_id).alias("item"), alnum_words(whole(item_text)).alias("words")
    )
    found = hits(texts, items, n, k, max_rows).select(
        F.col("doc").alias("hit_doc"),
        F.col("mark").alias("hit_mark"),
        _hit_words(F.col("spans")).alias("hit"),
        F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("names"),
    )
    counted = texts.select("doc", "mark", F.size("words").cast("long").alias("n_words"))
    same = F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("mark") == F.col("hit_mark"))
    zero = F.lit(0).cast("long")
    return (
        counted.join(found, same, "left")
        .select("doc", "n_words", F.coalesce("hit", zero).alias("n_hit"), "names")
        .select(
            F.col("doc").alias("doc_id"),
            "n_words",
            "n_hit",
            F.coalesce("names", F.array().cast("array<string>")).alias("items"),
            ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, with their columns as they are.

    The verdict depends on the text alone, so texts are told apart by their digest.
    """
    marked = docs.select(F.sha2(whole(text), 256).alias("digest"), F.col(text).alias("text"))
    bad = contamination(marked, benchmark, doc_id="digest", text="text", **options)
    names = {f"in_{i}": c for i, c in enumerate(docs.columns)}
    rows = docs.select(
        *(column(c).alias(k) for k, c in names.items()), F.sha2(whole(text), 256).alias("digest")
    )
    # Written, as the plan would run once more to measure it.
    bad = written(bad.where("contaminated").select(F.col("doc_id").alias("digest")).distinct(), "contaminated")
    left = matching(rows, bad, small=fits_broadcast(bad), how="left_anti")
    return left.select(*(F.col(k).alias(c) for k, c in names.items()))


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)

OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), {N_WORDS}) AS n,
          unnest(range(1, len(w) - least(len(w), {N_WORDS}) + 2)) AS p FROM i WHERE len(w) > 0)
),
dw AS (SELECT k, unnest(w) AS x, unnest(range(0, len(w))) AS p FROM d),
g AS (SELECT k, p, {N_WORDS} AS n,
        concat_ws(' ', {', '.join(f'lead(x, {j}) OVER o' for j in range(N_WORDS))}) AS phrase,
        lead(x, {N_WORDS - 1}) OVER o AS last
      FROM dw WINDOW o AS (PARTITION BY k ORDER BY p)),
s AS (SELECT DISTINCT k, array_to_string(w[p + 1:p + n], ' ') AS phrase, p, n
      FROM (SELECT k, w, n, unnest(range(0, len(w) - n + 1)) AS p
            FROM d, (SELECT DISTINCT n FROM iw WHERE n < {N_WORDS}))),
h AS (SELECT k, p, n, item_id FROM g JOIN iw USING (n, phrase) WHERE last IS NOT NULL
      UNION ALL SELECT k, p, n, item_id FROM s JOIN iw USING (n, phrase)),
c AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM h) GROUP BY k),
m AS (SELECT k, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM h GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (k) LEFT JOIN m USING (k)
"""
