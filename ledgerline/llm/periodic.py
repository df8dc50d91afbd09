"""Periodic runs of words, found on a grammar of every text.

Re-Pair turns the word ids of a text into a grammar: the most frequent pair of neighbours becomes a
nonterminal, again and again, until no pair occurs twice. A run of the text lies in the expansion of a
smallest node of the derivation and crosses a boundary there: the one of a nonterminal, or one of the
start rule. So the runs that cross a boundary within their node are looked for once for every
nonterminal, at one place where it is derived, and once for every boundary of the start rule. They are
moved to all places where the nonterminal is derived, and of the intervals of one period those inside
another one are merged into it.

Runs across a boundary have at least ``POWER`` periods, so one of four windows at the boundary
(beginning at it, ending at it, or one word over it) lies in the run together with its next or last
copy, one period away. Windows are named by doubling their length, only as long as they repeat in
their text; with a window as long as the period or longer, its nearest copy is one period away, so a
boundary has four candidates for all periods between two powers of two. Only their extent is then compared
word by word.

Null and empty texts have no words. Repeated rows and null ids each give a row. An empty table gives an
empty result. Only the named columns are read, so other columns may have any name. A text is one
task's work: time grows as n log n and memory with the length of the longest text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .batches import bounded
from .words import space_words, whole

POWER = 4
LEAST = 6
WORDS = 1 << 20  # of texts that are searched together


# ---- grammar ----


class Grammar:
    """Re-Pair of a sequence of ids. Symbols from ``first`` on are nonterminals."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.first = int(ids.max()) + 1 if n else 0
        self.rules: list[tuple[int, int]] = []  # of the nonterminals, in the order of their making
        self.lengths: list[int] = []
        self.places: list[int] = []  # where the nonterminal is derived once
        symbols = self._reduced(ids)
        self.start = [(i, s) for i, s in enumerate(symbols) if s >= 0]

    def _reduced(self, ids: np.ndarray) -> list[int]:
        """Symbols by the place where they begin, -1 inside of them."""
        n = len(ids)
        symbols = ids.tolist()
        if n < 4:
            return symbols
        pairs = ids[:-1].astype(np.int64) * self.first + ids[1:]
        order = np.argsort(pairs, kind="stable")
        ends = np.flatnonzero(np.append(np.diff(pairs[order]) != 0, True)) + 1
        starts = np.append(0, ends[:-1])
        often = ends - starts > 1
        queue = []
        for a, z in zip(starts[often].tolist(), ends[often].tolist()):
            at = order[a:z].tolist()
            queue.append((a - z, at[0], symbols[at[0]], symbols[at[0] + 1], at))
        if not queue:
            return symbols
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            count, _, left, right, places = heapq.heappop(queue)
            # What other rules have taken since is no longer a place of this pair.
            at, end = [], -1
            for i in places:
                if i >= end and symbols[i] == left and (j := after[i]) < n and symbols[j] == right:
                    at.append(i)
                    end = after[j]
            if len(at) < 2:
                continue
            if len(at) < -count:
                heapq.heappush(queue, (-len(at), at[0], left, right, at))
                continue
            new = self.first + len(self.rules)
            self.rules.append((left, right))
            self.lengths.append(after[after[at[0]]] - at[0])
            self.places.append(at[0])
            for i in at:
                j = after[i]
                symbols[i], symbols[j] = new, -1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
            fresh: dict[tuple[int, int], list[int]] = {}
            last = -1
            for i in at:
                h, k = before[i], after[i]
                if h > last:  # else the neighbour on the left is the last one's on the right
                    fresh.setdefault((symbols[h], new), []).append(h)
                if k < n:
                    fresh.setdefault((new, symbols[k]), []).append(i)
                last = i
            for (a, b), found in fresh.items():
                if len(found) > 1:
                    heapq.heappush(queue, (-len(found), found[0], a, b, found))
        return symbols

    def length(self, symbol: int) -> int:
        return self.lengths[symbol - self.first] if symbol >= self.first else 1

    def boundaries(self) -> tuple[list[int], list[int], list[int]]:
        """Place, begin and end of the node of every boundary: first the nonterminals', in order,
        then those of the start rule, whose node is the whole text."""
        n = sum(self.length(s) for _, s in self.start)
        middle = [p + self.length(left) for p, (left, _) in zip(self.places, self.rules)]
        ends = [p + k for p, k in zip(self.places, self.lengths)]
        cuts = [i for i, _ in self.start[1:]]
        return middle + cuts, self.places + [0] * len(cuts), ends + [n] * len(cuts)

    def derived(self, wanted: set[int]) -> dict[int, np.ndarray]:
        """All places where the wanted nonterminals (by number) are derived."""
        needed = [False] * len(self.rules)
        for k in range(len(self.rules)):
            needed[k] = k in wanted or any(s >= self.first and needed[s - self.first] for s in self.rules[k])
        # A parent of a wanted one is made later, so its places are known before they are handed down.
        found: dict[int, list] = {}
        for i, s in self.start:
            if s >= self.first and needed[s - self.first]:
                found.setdefault(s - self.first, []).append(np.array([i]))
        out = {}
        for k in range(len(self.rules) - 1, -1, -1):
            if not needed[k] or k not in found:
                continue
            places = np.concatenate(found.pop(k))
            if k in wanted:
                out[k] = places
            left, right = self.rules[k]
            if left >= self.first and needed[left - self.first]:
                found.setdefault(left - self.first, []).append(places)
            if right >= self.first and needed[right - self.first]:
                found.setdefault(right - self.first, []).append(places + self.length(left))
        return out


# ---- windows ----


def candidates(words: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator:
    """``(boundary, window place, window length, period)`` of possible runs across boundaries.

    ``words`` holds the ids of several texts, different ones in each. For windows of each power of two
    that still repeat, the nearest copies of the four windows at every boundary are looked up.
    """
    n = len(words)
    size = 1
    names, places = words.astype(np.int64), np.arange(n)
    longest = int((high - low).max(initial=0))
    while 2 * size <= longest:
        # ``places`` hold windows of ``size`` words, named by ``names`` there.
        order = np.argsort(names, kind="stable")
        sorted_names, sorted_places = names[order], places[order]
        same = sorted_names[1:] == sorted_names[:-1]
        after, before = np.full(n + 1, -1), np.full(n + 1, -1)
        after[sorted_places[:-1][same]] = sorted_places[1:][same]
        before[sorted_places[1:][same]] = sorted_places[:-1][same]
        for offset, copies in ((-1, after), (-size, after), (0, before), (1 - size, before)):
            i = at + offset
            ok = (i >= low) & (i + size <= high)
            copy = np.where(ok, copies[np.where(ok, i, n)], -1)
            period = np.abs(copy - i)
            ok &= (copy >= low) & (copy + size <= high) & (period <= size) & (2 * period > size)
            ok &= POWER * period <= high - low
            for b in np.flatnonzero(ok).tolist():
                yield b, int(min(i[b], copy[b])), size, int(period[b])
        # The next windows are two neighbouring ones that both repeat.
        repeats = np.zeros(n + 1, bool)
        repeats[sorted_places[1:][same]] = repeats[sorted_places[:-1][same]] = True
        number = np.full(n + 1, -1)
        number[sorted_places] = np.append(0, np.cumsum(~same)) if len(order) else 0
        places = np.flatnonzero(repeats)
        places = places[places + size < n]
        places = places[repeats[places + size]]
        if not len(places):
            return
        names = number[places] * (n + 1) + number[places + size]
        size *= 2


def _matches(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two sequences have in common at their beginning."""
    at, step, n = 0, 16, min(len(a), len(b))
    while at < n:
        differ = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = min(at + step, n), 2 * step
    return n


def extent(words: np.ndarray, at: int, size: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch of the period around the window at ``at`` and its copy."""
    right = at + size + _matches(words[at + size : high - period], words[at + size + period : high])
    left = at - _matches(words[low:at][::-1], words[low + period : at + period][::-1])
    return left, right + period


# ---- runs ----


def merged(pieces: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the pieces ``(start, end, period)`` inside no other of their
    period, by start, then period."""
    order = np.lexsort((-pieces[:, 1], pieces[:, 0], pieces[:, 2]))
    pieces = pieces[order]
    out, period, reach = [], 0, 0
    for start, end, p in pieces.tolist():
        if p != period:
            period, reach = p, 0
        if end > reach:
            out.append((start, end - start, p))
            reach = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs of several texts given as ids that count from 0 in each text."""
    grammars = [Grammar(t) for t in texts]
    begins = np.cumsum([0] + [len(t) for t in texts]).tolist()
    words, at, low, high, owner = [], [], [], [], []
    base = 0
    for k, (text, grammar) in enumerate(zip(texts, grammars)):
        words.append(text.astype(np.int64) + base)
        base += grammar.first
        middle, begin, end = grammar.boundaries()
        at.append(np.array(middle, np.int64) + begins[k])
        low.append(np.array(begin, np.int64) + begins[k])
        high.append(np.array(end, np.int64) + begins[k])
        owner.append(np.full(len(middle), k))
    empty = np.zeros(0, np.int64)
    words, at, low, high, owner = (np.concatenate([empty, *x]) for x in (words, at, low, high, owner))
    firsts = np.searchsorted(owner, np.arange(len(texts)))
    found: dict[int, set] = {}  # by boundary, relative to its node
    for b, i, size, period in candidates(words, at, low, high):
        if any(p == period and low[b] + s <= i < low[b] + e for s, e, p in found.get(b, ())):
            continue
        s, e = extent(words, i, size, period, int(low[b]), int(high[b]))
        if e - s >= max(LEAST, POWER * period):
            found.setdefault(b, set()).add((s - int(low[b]), e - int(low[b]), period))
    by_text: dict[int, list[tuple[int, set]]] = {}
    for b, pieces in found.items():
        by_text.setdefault(int(owner[b]), []).append((b - int(firsts[owner[b]]), pieces))
    out: list[list] = [[] for _ in texts]
    for k, boundaries in by_text.items():
        grammar = grammars[k]
        places = grammar.derived({b for b, _ in boundaries if b < len(grammar.rules)})
        moved = []
        for b, pieces in boundaries:
            where = places[b] if b < len(grammar.rules) else np.zeros(1, np.int64)
            for s, e, p in pieces:
                moved.append(np.stack((where + s, where + e, np.full(len(where), p)), axis=1))
        out[k] = merged(np.concatenate(moved))
    return out


def dropped(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Marks the words that stand in a run behind its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) > 0


RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _searched(texts: pd.Series) -> pd.DataFrame:
    rows = []
    group, size = [], 0
    for text in texts:
        # Bytes are split at ASCII white space only.
        group.append(text.encode("utf-8", "surrogatepass").split())
        size += len(group[-1])
        if size >= WORDS:
            rows += _group(group)
            group, size = [], 0
    rows += _group(group)
    return pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])


def _group(texts: list[list[bytes]]) -> list[tuple]:
    ids = []
    for words in texts:
        number: dict[bytes, int] = {}
        ids.append(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
    rows = []
    for words, runs in zip(texts, runs_of(ids)):
        kept = words
        if runs:
            gone = dropped(runs, len(words)).tolist()
            kept = [w for w, g in zip(words, gone) if not g]
        collapsed = b" ".join(kept).decode("utf-8", "replace")
        rows.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], collapsed))
    return rows


def periodic_runs(text: Column) -> Column:
    """Struct of the number of words, the runs by start, then period, and the text with one period of
    every run left."""
    return F.pandas_udf(_searched, RESULT)(F.coalesce(text.cast("string"), F.lit("")))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row."""
    bounded(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), periodic_runs(F.col(text)).alias("found"))
    return rows.select("doc_id", "found.*")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with a stretch repeated up to the end of every tenth text, by the contract's
    rule. A row without an id stays as it is."""
    rows = docs.select("doc_id", whole("text").alias("text"), F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.select("*", F.when(F.col("h") % 10 == 0, space_words(F.col("text"))).alias("w"), F.floor(F.col("h") / 10).alias("g"))
    n = F.size("w")
    rows = rows.select("*", F.when(n > 0, F.col("g") % n).cast("int").alias("a"))
    period = (1 + F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.select("*", period.alias("p"))
    repeated = F.transform(
        "w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p")))
    )
    return rows.select(
        "doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(repeated, " ")).alias("text")
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find(with_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # The greatest by length, then the smallest by start and period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    rows = rows.select("*", best.alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.l") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
