"""SentencePiece encoding and decoding with a lattice of pieces as a relation.

Words are cut where no piece of the table reaches over: before spaces and, if the table allows it,
where Latin letters begin or end. For the words that are most frequent in the corpus,
all substrings up to the longest piece are exploded and joined to the piece table; the edges are
grouped by word, and a fold with ``aggregate`` picks the segmentation.

The model at hand is of the BPE type: its scores are merge ranks, and the library merges the
adjacent pair with the best score again and again. The path with the best sum of scores (Viterbi)
is another one, so the fold here merges over the lattice instead; the ids equal the library's.

The table of segmented words is bounded by ``known_words``, so it is sent to every task. Any other
word, and any longer than ``LONGEST`` characters, is merged by the same rule where it stands, with
a heap. Nothing of the text is shuffled but distinct words with their counts.

Null and empty texts have no ids and decode to an empty text. U+2581 decodes to a space, as in the
library. Repeated rows and null ids each give a row; an empty table gives an empty result. Only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import re
from array import array
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from ..sources.scratch import written
from .batches import bounded
from .words import whole

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# Latin letters, which most models join with each other and with spaces in front only.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
WIDE_WORD = f"{SPACE}+[^{SPACE}]*"
WORD = f"{SPACE}*[{LETTER}]+|{SPACE}*[^{LETTER}{SPACE}]+|{SPACE}+"
REACHES_OVER = re.compile(f"[{LETTER}][^{LETTER}]|[^{LETTER}{SPACE}][{LETTER}]|[^{SPACE}]{SPACE}")
KNOWN_WORDS = 1 << 18
LONGEST = 32
REMEMBERED = 1 << 16
NEVER = float("inf")


class Pieces:
    """The piece table of a model: at most a few ten thousand rows."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        byte = [model.is_byte(i) for i in range(size)]
        self.scores = {
            p: (model.get_score(i), i)
            for i, p in enumerate(self.names)
            if not (special[i] or byte[i])
        }
        ids = [i for i in range(size) if byte[i]]  # in order of the bytes
        self.byte_ids = ids
        self.bytes = {i: b for b, i in enumerate(ids)}
        self.is_byte = np.array(byte)
        self.longest = max(map(len, self.scores))
        self.ranks = {p: -score for p, (score, _) in self.scores.items()}
        # No piece may reach over an end of a word, so the table decides where words end.
        self.word = WIDE_WORD if any(map(REACHES_OVER.search, self.scores)) else WORD
        self.words = re.compile(self.word).findall

    def ids(self, segments) -> list[int]:
        """A segment that is no piece is a character; it becomes its bytes."""
        out = []
        for s in segments:
            found = self.scores.get(s)
            if found:
                out.append(found[1])
            else:
                out.extend(self.byte_ids[b] for b in s.encode("utf-8", "surrogatepass"))
        return out

    def merged(self, word: str) -> list[str]:
        """Merge the adjacent pair with the best score, the left one of equals, until none is
        left. A list is fastest for short words; a heap bounds the time of long ones."""
        return self.merged_short(word) if len(word) <= 2 * LONGEST else self.merged_long(word)

    def merged_short(self, word: str) -> list[str]:
        parts, rank = list(word), self.ranks.get
        pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        return parts

    def merged_long(self, word: str) -> list[str]:
        """Time grows as n log n."""
        n, scores = len(word), self.scores
        end = list(range(1, n + 1))  # of the segment that starts here; 0: merged into another
        before = list(range(-1, n - 1))
        heap = []

        def offer(a: int, b: int) -> None:
            found = scores.get(word[a : end[b]])
            if found:
                heapq.heappush(heap, (-found[0], a, b, end[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, stop = heapq.heappop(heap)
            if end[a] != b or end[b] != stop:
                continue
            end[a], end[b] = stop, 0
            if stop < n:
                before[stop] = a
                offer(a, stop)
            if before[a] >= 0:
                offer(before[a], a)
        out, at = [], 0
        while at < n:
            out.append(word[at : end[at]])
            at = end[at]
        return out


@cache
def pieces(name: str = MODEL) -> Pieces:
    import public_tokenizers

    return Pieces(public_tokenizers.path(name))


def frequent_words(docs: DataFrame, text: str, most: int, word: str = WORD) -> DataFrame:
    """``(word)``: at most ``most`` words, all of which are at least as frequent as any other."""
    body = whole(text)
    marked = F.concat(F.lit(SPACE), F.replace(body, F.lit(" "), F.lit(SPACE)))
    found = F.regexp_extract_all(marked, F.lit(word), F.lit(0))
    words = docs.where(body != "").select(F.explode(found).alias("word"))
    words = words.where(F.char_length("word") <= LONGEST)
    counts = written(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    # One row per different count, not per word.
    order = Window.orderBy(F.desc("n"))
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    least = (
        by_count.withColumn("sum", F.sum("words").over(order))
        .where(F.col("sum") <= most)
        .agg(F.min("n"))
        .first()[0]
    )
    return counts.where(F.col("n") >= least).select("word") if least else counts.select("word").limit(0)


def lattice(words: DataFrame, table: Pieces) -> DataFrame:
    """``(word, edges)``: every piece of two characters or more that stands in a word, by place."""
    spark = words.sparkSession
    rows = spark.createDataFrame(
        [(p, s) for p, (s, _) in table.scores.items()], "piece string, score double"
    )
    size = F.char_length("word")
    parts = words.select("word", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    last = F.least(size, F.col("start") + table.longest)
    # Segments begin as characters, so an edge has two of them at least.
    ends = F.when(F.col("start") + 2 <= last, F.sequence(F.col("start") + 2, last))
    parts = parts.select("word", "start", F.explode_outer(ends).alias("end"))
    parts = parts.select(
        "*", F.substring("word", F.col("start") + 1, F.col("end") - F.col("start")).alias("piece")
    )
    edge = F.when(
        F.col("score").isNotNull(),
        F.struct("score", (-F.col("start")).alias("left"), "start", "end"),
    )
    joined = parts.join(F.broadcast(rows), "piece", "left")
    return joined.groupBy("word").agg(F.collect_list(edge).alias("edges"))


def segmented(edges: DataFrame) -> DataFrame:
    """``(word, segments)``: the fold over the lattice. The state is the list of cuts; a step takes
    out the cut inside the best edge that spans two neighbouring segments."""
    cuts = F.sequence(F.lit(0), F.char_length("word"))

    def step(state, _):
        def spans_two(e):
            low, high = F.array_position(state, e["start"]), F.array_position(state, e["end"])
            return (low > 0) & (high == low + 2)

        def without_inner(best):
            kept = F.filter(state, lambda c: (c <= best["start"]) | (c >= best["end"]))
            return F.when(best.isNull(), state).otherwise(kept)

        # As the one element of an array the best edge is found once, not once for every cut.
        best = F.array(F.array_max(F.filter("edges", spans_two)))
        return F.get(F.transform(best, without_inner), F.lit(0))

    final = F.aggregate(F.sequence(F.lit(1), F.char_length("word")), cuts, step)
    rows = edges.select("word", final.alias("cuts"))
    segments = F.transform(
        F.sequence(F.lit(1), F.size("cuts") - 1),
        lambda i: F.substring(
            "word", F.get("cuts", i - 1) + 1, F.get("cuts", i) - F.get("cuts", i - 1)
        ),
    )
    return rows.select("word", segments.alias("segments"))


def packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Memory(dict):
    """Packed ids by word: the known words, and others as they come up, at most ``REMEMBERED`` of
    them."""

    def __init__(self, known: dict, table: Pieces):
        super().__init__(known)
        self.known, self.table, self.others = known, table, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.others.get(word)
        if ids is None:
            ids = packed(self.table.ids(self.table.merged(word)))
            if len(word) <= LONGEST:
                if len(self.others) >= REMEMBERED:
                    self.others.clear()
                self.others[word] = ids
        return ids


class Encoder:
    """Ids of texts in tasks, from the broadcast table and merges for the rest."""

    def __init__(self, known, model: str):
        self.known, self.model = known, model

    def __call__(self, texts: pd.Series) -> pd.Series:
        ids_of = _memory(self.known, self.model).__getitem__
        return pd.Series([self.encode(t, ids_of) for t in texts], dtype=object)

    def encode(self, text: str, ids_of) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        words = pieces(self.model).words(SPACE + text.replace(" ", SPACE))
        return np.frombuffer(b"".join(map(ids_of, words)), np.int32)


_memories: dict[str, Memory] = {}


def _memory(known, model: str) -> Memory:
    """A worker's memory for the broadcast table; one of an earlier table is let go."""
    found = _memories.get(model)
    if found is None or found.known is not known.value:
        found = _memories[model] = Memory(known.value, pieces(model))
    return found


class Decoder:
    def __init__(self, model: str):
        self.model = model

    def __call__(self, rows: pd.Series) -> pd.Series:
        return pd.Series([self.decode(r) for r in rows], dtype=object)

    def decode(self, ids) -> str:
        table, ids = pieces(self.model), np.asarray(ids, np.int64)
        is_byte = table.is_byte[ids]
        # Stretches of pieces and of bytes take turns.
        ends = [*(np.flatnonzero(is_byte[1:] != is_byte[:-1]) + 1).tolist(), len(ids)]
        out, at, flags, ids = [], 0, is_byte.tolist(), ids.tolist()
        for end in ends if ids else ():
            if flags[at]:
                out.append(bytes(map(table.bytes.__getitem__, ids[at:end])).decode("utf-8", "replace"))
            else:
                out += map(table.names.__getitem__, ids[at:end])
            at = end
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def encoder(docs: DataFrame, text: str = "text", model: str = MODEL, known_words: int = KNOWN_WORDS):
    """A function from text column to ids column, fitted to the words of ``docs``."""
    table, spark = pieces(model), docs.sparkSession
    bounded(spark)
    words = written(segmented(lattice(frequent_words(docs, text, known_words, table.word), table)), "words")
    # At most ``known_words`` rows of at most ``LONGEST`` characters.
    known = {r["word"]: packed(table.ids(r["segments"])) for r in words.toLocalIterator()}
    run = Encoder(spark.sparkContext.broadcast(known), model)

    def ids(texts: pd.Series) -> pd.Series:
        return run(texts)

    udf = F.pandas_udf(ids, ArrayType(IntegerType()))
    return lambda column: udf(F.coalesce(column.cast("string"), F.lit("")))


def decoded(ids: Column, model: str = MODEL) -> Column:
    run = Decoder(model)

    def texts(rows: pd.Series) -> pd.Series:
        return run(rows)

    # Ids straight from the encoder would be chained into this function and encoded once more for
    # it; behind a built-in function they are taken from the column.
    none = F.array().cast(ArrayType(IntegerType()))
    return F.pandas_udf(texts, StringType())(F.coalesce(ids, none))


def encode(docs: DataFrame, text: str = "text", name: str = "ids", **options) -> DataFrame:
    """``docs`` with the ids of ``text`` in a column more; a column of that name is replaced."""
    return docs.withColumn(name, encoder(docs, text, **options)(F.col(text)))


def op6_sentencepieces(spark, sf_dir: str) -> DataFrame:
    """Number and hash of the ids of every text, and whether decoding gives the text back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", whole("text").alias("body"))
    rows = encode(docs, "body")
    return rows.select(
        "doc_id",
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        (decoded(F.col("ids")) == F.replace("body", F.lit(SPACE), F.lit(" "))).alias("round_trip"),
    )
