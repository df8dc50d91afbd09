"""Spelling variants by composition of finite-state machines.

The words of the corpus form a vocabulary. Two of them are near if one edit (a code point inserted,
deleted or replaced) turns one into the other, that is, if the composition *vocabulary acceptor, one-edit
transducer, vocabulary acceptor* accepts the pair.

The composition is dealt out by initial states. One edit leaves one half of a word as it is, so a pair
meets in the partition of the left half that both share, where the machines start behind that half, or
else in the partition of the right half, where the machines end before it. Lengths differ by one at
most, so a word of ``n`` code points goes to the partitions of lengths ``n`` and ``n - 1``: four rows a
word. A partition with more than ``MAX_PARTITION`` words, or more than ``MAX_REST`` code points left, is
halved again in the same way, its two halves being those of what is left of the words, until it fits;
words that differ in one place only are as many as the alphabet has letters, so this ends. Every pair
belongs to exactly one partition: to the left half's if both share it, and to the right half's otherwise.

In a partition the left words (of the partition's length) and all its words are two minimised
acyclic acceptors of what is left of the words. The transducer copies until its one edit and copies
again behind it. Before the edit the composition walks the acceptors in step; behind it a pair of
states accepts what both accept, and that is remembered by pair of states.

A word's form is its near word of largest count if that is at least ``RATIO`` times as frequent, and
forms are followed to the last by pointer doubling: counts rise tenfold at every step, so chains are
short and have no cycles.

Null texts have no words, a null id counts as an empty text. Repeated rows count again. An empty table
gives an empty result. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import fits_broadcast, matching
from ..sources.scratch import written
from .batches import bounded
from .words import ascii_lower, whole

MIN_CHARS = 7
MIN_COUNT = 2
RATIO = 10
TYPO_EVERY = 31
MAX_PARTITION = 1024
MAX_REST = 64
RUN = f"[a-zÀ-ÿ]{{{MIN_CHARS},}}"


# ---- vocabulary ----


def letter_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, run)``: maximal runs of ``MIN_CHARS`` or more letters in ASCII lower case."""
    runs = F.regexp_extract_all(ascii_lower(whole(text)), F.lit(RUN), F.lit(0))
    ident = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return docs.select(ident.alias("doc_id"), F.explode(runs).alias("run"))


def with_typos() -> Column:
    """The run, without one code point where its place in the corpus hashes to a multiple of
    ``TYPO_EVERY``."""
    h = F.crc32(F.concat_ws(":", "doc_id", "run"))
    at = F.pmod(h, F.char_length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return F.when(h % TYPO_EVERY == 0, rest).otherwise(F.col("run"))


def vocabulary(words: DataFrame) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.char_length("word") >= MIN_CHARS) & (F.col("n") >= MIN_COUNT))


# ---- machines ----


class Acceptor:
    """Minimised acyclic acceptor of sorted words; equal right languages are one state."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        register: dict = {}

        def frozen(arcs: dict[str, int], final: bool) -> int:
            key = (final, *arcs.items())
            state = register.get(key)
            if state is None:
                state = register[key] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
            return state

        path: list[tuple[dict, bool]] = [({}, False)]
        before = ""
        for word in [*words, None]:
            shared = 0
            if word is not None:
                most = min(len(before), len(word))
                while shared < most and before[shared] == word[shared]:
                    shared += 1
            while len(path) > shared + 1:  # what no later word can change
                arcs, final = path.pop()
                path[-1][0][before[len(path) - 1]] = frozen(arcs, final)
            if word is None:
                break
            path.extend(({}, False) for _ in range(len(word) - shared))
            path[-1] = (path[-1][0], True)
            before = word
        self.start = frozen(*path[0])


def near_pairs(left: Acceptor, right: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs that the composition accepts: the right word is the left one with one code point
    replaced or inserted. A pair of several alignments may come more than once."""
    remembered: dict[tuple[int, int], list[str]] = {}

    def both(a: int, b: int) -> list[str]:
        """What two states accept alike: the machine behind its edit."""
        found = remembered.get((a, b))
        if found is None:
            found = [""] if left.final[a] and right.final[b] else []
            there = right.arcs[b]
            for c, to in left.arcs[a].items():
                if c in there:
                    found += [c + rest for rest in both(to, there[c])]
            remembered[a, b] = found
        return found

    stack = [("", left.start, right.start)]
    while stack:
        copied, a, b = stack.pop()
        here, there = left.arcs[a], right.arcs[b]
        for d, over in there.items():
            for rest in both(a, over):
                yield copied + rest, copied + d + rest
            for c, to in here.items():
                if c != d:
                    for rest in both(to, over):
                        yield copied + c + rest, copied + d + rest
        stack += [(copied + c, to, there[c]) for c, to in here.items() if c in there]


def partition_pairs(rests: list[str], length: int) -> set[tuple[str, str]]:
    """Near pairs of a partition whose left words have ``length`` code points left; of two words of
    that length the smaller one is left."""
    words = sorted(set(rests))
    own = [w for w in words if len(w) == length]
    if not own or len(words) < 2:
        return set()
    pairs = near_pairs(Acceptor(own), Acceptor(words))
    return {(a, b) for a, b in pairs if len(b) > length or a < b}


# ---- partitions ----

# A partition holds words that share ``head`` and ``tail``; ``size`` is the length of its left words and
# ``bar`` the least length of a common beginning that belongs to another partition.
KEY = ["size", "head", "tail"]


def _halved(rows: DataFrame) -> DataFrame:
    """Each row in the partitions of the left and of the right half of what is left of its word."""
    before, behind = F.char_length("head"), F.char_length("tail")
    half = ((F.col("size") - before - behind) / 2).cast("int")
    mark = before + half
    rest = F.col("size") - mark
    left = F.struct(
        F.substring("word", F.lit(1), mark).alias("head"), F.col("tail").alias("tail"), F.col("bar").alias("bar")
    )
    right = F.struct(
        F.col("head").alias("head"),
        F.substring("word", F.char_length("word") - rest + 1, rest).alias("tail"),
        mark.alias("bar"),
    )
    rows = rows.select("word", "n", "size", F.explode(F.array(left, right)).alias("at"))
    return rows.select("word", "n", "size", "at.head", "at.tail", "at.bar")


def partitions(words: DataFrame, most: int = MAX_PARTITION) -> DataFrame:
    """``(size, head, tail, bar, members)`` of all partitions that can have a pair; ``members`` are at
    most ``most`` words with their counts."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("size"))
    rows = rows.where(F.col("size") >= MIN_CHARS).select(
        "*", F.lit("").alias("head"), F.lit("").alias("tail"), F.lit(1 << 30).alias("bar")
    )
    done = None
    rows = _halved(rows)
    while True:
        rows = written(rows, "spelling-keys")
        sizes = rows.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("k"), F.min(F.char_length("word") - F.col("size")).alias("own")
        )
        # What is left of a word has one code point at least; one alone is not halved further.
        rest = F.col("size") - F.char_length("head") - F.char_length("tail")
        large = (F.col("k") > most) | (F.col("k") > 1) & (rest > MAX_REST)
        large = written(sizes.where(large & (rest > 1)).select(*KEY, "own"), "large")
        if large.isEmpty():
            return _packed(rows if done is None else done.unionByName(rows))
        keys = large.select(*KEY)
        small = fits_broadcast(keys)
        last = matching(rows, keys, small=small, how="left_anti")
        done = last if done is None else done.unionByName(last)
        # Without a word of its own length a partition has no pair.
        rows = _halved(matching(rows, large.where("own = 0").select(*KEY), small=small))


def _packed(rows: DataFrame) -> DataFrame:
    packed = rows.groupBy(*KEY).agg(
        F.first("bar").alias("bar"), F.collect_list(F.struct("word", "n")).alias("members")
    )
    # Alone, or without a word of the partition's own length: no pair.
    own = F.exists("members", lambda m: F.char_length(m["word"]) == F.col("size"))
    return packed.where((F.size("members") > 1) & own)


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per partition and word: how many near words, and the one of largest count."""
    for batch in batches:
        out = []
        for size, head, tail, bar, members in zip(*(batch[c] for c in (*KEY, "bar", "members"))):
            counts = {m["word"]: m["n"] for m in members}
            a, z = len(head), len(tail)
            found: dict[str, list] = {}
            for u, v in partition_pairs([w[a : len(w) - z] for w in counts], size - a - z):
                u, v = head + u + tail, head + v + tail
                if u[:bar] == v[:bar]:  # their common beginning puts them elsewhere
                    continue
                for word, near in ((u, v), (v, u)):
                    best = found.setdefault(word, [0, 0, ""])
                    best[0] += 1
                    n = counts[near]
                    if n > best[1] or n == best[1] and near < best[2]:
                        best[1:] = n, near
            out += [(w, *f) for w, f in found.items()]
        yield pd.DataFrame(out, columns=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame, most: int = MAX_PARTITION) -> DataFrame:
    """``(word, n_near, near, near_n)`` of the words that have near words; ``near`` is the one of
    largest count, of equals the smallest."""
    bounded(words.sparkSession)
    found = partitions(words, most).mapInPandas(_near, "word string, n_near bigint, near_n bigint, near string")
    # Spark compares text by its bytes in UTF-8, which is the order of code points.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


# ---- forms ----


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the rows ``(word, form)``, by pointer doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(on, "root", "left")
        step = step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = written(step, "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(words: DataFrame, most: int = MAX_PARTITION, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for a vocabulary ``(word, n)``."""
    words = written(words.select("word", "n"), "vocabulary")
    near = near_words(words, most)
    rows = words.join(near, "word", "left")
    better = F.col("near_n") >= ratio * F.col("n")
    rows = written(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(better, F.col("near")).alias("form"), F.when(better, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(rows.where(F.col("form").isNotNull()))
    rows = rows.join(ends, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents, with typing errors put in by the contract's rule."""
    runs = letter_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return variants(vocabulary(runs.select(with_typos().alias("word"))))


# CRC-32 as the polynomial division that defines it, a byte at a time, over a table made here.
OP12_SQL = r"""
WITH RECURSIVE polynomial(i, step, c) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END
  FROM polynomial WHERE step < 8
), crc AS (
  SELECT list(c ORDER BY i) AS steps FROM polynomial WHERE step = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{7,}')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS times, hex(encode(doc_id || ':' || run)) AS digits FROM runs GROUP BY 1, 2
), hashed AS (
  SELECT run, times, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(0, length(digits), 2),
      lambda i: ('0x' || substring(digits, i + 1, 2))::UBIGINT)),
    lambda a, b: xor(steps[(xor(a, b) % 256)::BIGINT + 1], a >> 8))) AS h
  FROM counted, crc
), typed AS (
  SELECT times, CASE WHEN h % 31 = 0
    THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), shorter AS (
  SELECT word, n, i, left(word, i::INT) || substring(word, i::INT + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words) x
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b USING (i, rest) WHERE a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n,
    CASE WHEN b.top >= 10 * w.n
      THEN (SELECT min(o.other) FROM near o WHERE o.word = w.word AND o.other_n = b.top) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain(word, root) AS (
  SELECT word, form FROM formed WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), last AS (
  SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT f.word, f.form, coalesce(l.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f LEFT JOIN last l ON l.word = f.word
"""
