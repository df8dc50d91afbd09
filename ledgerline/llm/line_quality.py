"""Quality of documents from a linear-chain conditional random field over their lines.

Every line has two states, bad and good. The weight of a state comes from features of the line and
of its neighbours; neighbouring states have weights of their own. Forward-backward gives the
probability that a line is good; a document's score is the mean over its lines, weighted by length.

Lines have no labels. In training every line of a document has the document's label, so the field
learns what lines of good and bad documents look like and how states follow each other. It is
fitted by gradient ascent on a bounded sample: at most ``SAMPLE`` labelled documents, the first by
a hash of the id, so the sample is spread evenly over the labelled rows; of them at most
``SAMPLE_LINES`` lines in all. A document whose lines no longer fit into that is passed over and
the next ones are taken. Rows of the held-out share never are in it. Labels, language, source and
id are no features.

Null and empty texts have no lines and the score of the training rows' share of good documents.
Repeated rows and null ids each give a row; a null id is hashed as empty text. Labels without a
text, and rows with a null label, are left out of training; without labels of both kinds every
score is 0.5. An empty table gives an empty result. Only the named columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .batches import bounded
from .words import whole

SAMPLE = 3000
SAMPLE_LINES = 200_000
BATCH_LINES = 1 << 16
STEPS = 150
RATE = 0.1
PENALTY = 1e-3
FEATURES = 12
SYMBOLS = frozenset("#*$%&|<>~^=_\\")
ENDS = frozenset(".!?:;\"'")


def lines_of(text: str) -> list[str]:
    return [x for x in text.split("\n") if not x.isspace() and x]


def line_features(line: str, seen: set[str]) -> tuple[float, ...]:
    """Shares between 0 and 1, apart from logarithms of lengths."""
    words = line.split()
    n, size = max(1, len(words)), len(line)
    distinct = len(set(words))
    letters = sum(map(str.isalpha, line))
    lower = line.lower()
    return (
        np.log1p(n) / 5,
        size / n / 10,
        distinct / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        letters / size,
        sum(a != b and a.isupper() for a, b in zip(line, lower)) / max(1, letters),
        sum(map(line.count, SYMBOLS)) / n,
        line.count("!") / n,
        sum(map(str.isdigit, line)) / size,
        float(line in seen),
        float(line.rstrip()[-1:] in ENDS),
        sum(len(w) <= 3 for w in words) / n,
    )


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row per line: its own features, those of the lines before and after, and whether there
    are such; and the lengths of the lines."""
    lines, seen, own = lines_of(text), set(), []
    for line in lines:
        own.append(line_features(line, seen))
        seen.add(line)
    x = np.array(own, float).reshape(-1, FEATURES)
    if not len(x):
        return np.zeros((0, 3 * FEATURES + 3)), np.zeros(0)
    nothing = np.zeros((1, FEATURES))
    first, last = np.zeros(len(x)), np.zeros(len(x))
    first[0] = last[-1] = 1
    before, after = np.vstack((nothing, x[:-1])), np.vstack((x[1:], nothing))
    return np.column_stack((x, before, after, first, last, np.ones(len(x)))), np.array([len(s) for s in lines], float)


@dataclass
class Field:
    """``state``: weights of good against bad; ``move``: weights of neighbouring states."""

    state: np.ndarray
    move: np.ndarray
    prior: float

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """Probability of good of every line of one document, by forward-backward."""
        good = x @ self.state
        own = np.column_stack((np.zeros(len(x)), good))
        step = np.exp(self.move)
        own = np.exp(own - own.max(axis=1, keepdims=True))
        ahead, back = np.empty_like(own), np.empty_like(own)
        at = own[0] / own[0].sum()
        ahead[0] = at
        for i in range(1, len(own)):
            at = (at @ step) * own[i]
            at = at / at.sum()
            ahead[i] = at
        at = np.ones(2)
        back[-1] = at
        for i in range(len(own) - 2, -1, -1):
            at = step @ (own[i + 1] * at)
            at = at / at.sum()
            back[i] = at
        both = ahead * back
        return both[:, 1] / both.sum(axis=1)

    def score(self, text: str) -> float:
        x, sizes = features(text)
        if not len(x):
            return self.prior
        return float(np.average(self.marginals(x), weights=sizes))


def _padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, docs))
    x, there = np.zeros((len(docs), longest, docs[0].shape[1])), np.zeros((len(docs), longest), bool)
    for i, d in enumerate(docs):
        x[i, : len(d)], there[i, : len(d)] = d, True
    return x, there


def _batches(sizes: list[int], most: int = BATCH_LINES) -> list[list[int]]:
    """Chains of like length side by side: at most ``most`` lines with the padding, unless one
    chain is longer, and no chain padded to more than twice its length."""
    parts, shortest = [], 0
    for i in np.argsort(sizes, kind="stable").tolist():
        if not parts or sizes[i] > 2 * shortest or (len(parts[-1]) + 1) * sizes[i] > most:
            parts.append([])
            shortest = sizes[i]
        parts[-1].append(i)
    return parts


def _expected(x, there, state, move):
    """Marginals of states and summed marginals of pairs for a batch of chains."""
    n, longest = there.shape
    good = x @ state
    own = np.stack((np.zeros_like(good), good), axis=-1)
    own = np.exp(own - own.max(axis=-1, keepdims=True))
    step = np.exp(move)
    ahead, back = np.zeros((n, longest, 2)), np.ones((n, longest, 2))
    ahead[:, 0] = own[:, 0] / own[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, longest):
        at = (ahead[:, i - 1] @ step) * own[:, i]
        at = at / at.sum(axis=1, keepdims=True)
        ahead[:, i] = np.where(there[:, i, None], at, ahead[:, i - 1])
    for i in range(longest - 2, -1, -1):
        at = (own[:, i + 1] * back[:, i + 1]) @ step.T
        at = at / at.sum(axis=1, keepdims=True)
        back[:, i] = np.where(there[:, i + 1, None], at, 1.0)
    both = ahead * back
    single = both / both.sum(axis=-1, keepdims=True)
    pairs = ahead[:, :-1, :, None] * step * (own[:, 1:] * back[:, 1:])[:, :, None, :]
    pairs = pairs / pairs.sum(axis=(2, 3), keepdims=True)
    pairs = (pairs * there[:, 1:, None, None]).sum(axis=(0, 1))
    return single[..., 1], pairs


def fit(docs: list[np.ndarray], labels: np.ndarray, steps: int = STEPS) -> Field:
    """Maximum likelihood with a square penalty, by Adam; bounded by the sample's size."""
    prior = float(labels.mean()) if len(labels) else 0.5
    width = 3 * FEATURES + 3
    state, move = np.zeros(width), np.zeros((2, 2))
    if not docs or len(set(labels.tolist())) < 2:
        return Field(state, move, 0.5)
    batches = []
    for part in _batches([len(d) for d in docs]):
        x, there = _padded([docs[i] for i in part])
        batches.append((x, there, labels[part].astype(float)))
    total = sum(map(len, docs))
    theta = np.concatenate((state, move.ravel()))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        state, move = theta[:width], theta[width:].reshape(2, 2)
        g_state, g_move = np.zeros(width), np.zeros((2, 2))
        for x, there, y in batches:
            single, pairs = _expected(x, there, state, move)
            g_state += np.einsum("nlf,nl->f", x, (y[:, None] - single) * there)
            moves = there[:, 1:].sum(axis=1)
            seen = np.diag((float((moves * (1 - y)).sum()), float((moves * y).sum())))
            g_move += seen - pairs
        slope = np.concatenate((g_state, g_move.ravel())) / total - PENALTY * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta + RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Field(theta[:width], theta[width:].reshape(2, 2), prior)


def held_out(doc_id: Column) -> Column:
    """The share of rows that is never learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    lines: int = SAMPLE_LINES,
) -> Field:
    """Fit on at most ``sample`` labelled rows and ``lines`` lines; features are made in tasks."""
    bounded(docs.sparkSession)
    wanted = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col(doc_id)))
    wanted = wanted.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    # A label's rows are told apart by id; of several labels of one id the smallest counts.
    wanted = wanted.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("label").alias("label"))
    chosen = wanted.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("id"), whole(text).alias("body"))

    def feature_lists(texts: pd.Series) -> pd.Series:
        fits = [t if t.count("\n") < lines or len(lines_of(t)) <= lines else "" for t in texts]
        return pd.Series([features(t)[0].ravel() for t in fits], dtype=object)

    listed = F.pandas_udf(feature_lists, ArrayType(DoubleType()))
    found = rows.join(F.broadcast(chosen), "id").select("id", "label", listed("body").alias("x"))
    kept, total = [], 0
    for r in found.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").toLocalIterator():
        x = np.array(r["x"]).reshape(-1, 3 * FEATURES + 3)
        if total + len(x) > lines:
            continue
        if len(x):
            kept.append((x, r["label"]))
            total += len(x)
    return fit([x for x, _ in kept], np.array([y for _, y in kept]))


def scored(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row; no shuffle."""
    ident = F.col(doc_id)
    bounded(docs.sparkSession)

    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([field.score(t) for t in texts], dtype=float)

    score = F.pandas_udf(scores, DoubleType())(whole(text))
    rows = docs.select(ident.alias("doc_id"), held_out(ident).alias("held_out"), score.alias("score"))
    return rows.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_line_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
