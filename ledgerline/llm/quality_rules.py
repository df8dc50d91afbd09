"""Quality rules as a cascade that stops at the first rule that rejects.

On a bounded sample the time of every rule is measured, once it has run before and less the time of a
job without a rule, and which rules reject which texts. The first rule is that of most rejections by
cost; each next one is so among the texts that are left. The order changes the time only: a text is
kept if no rule rejects it, in whatever order they stand. Measures that only rules need are taken of
texts that no earlier rule has rejected.

Null and empty texts have no words and are rejected. Repeated rows and null ids are rows like any
other; an empty table gives an empty result; only the named columns are read, so others may have
any name.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .words import column, covered, space_words, whole, window_hashes

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
SAMPLE_ROWS = 500
SAMPLE_BYTES = 64 << 10
# Ends and beginnings of lines that the rules count; RE2 and Java read them alike.
ELLIPSIS = r"(?:\.\.\.|\x{2026})[\x20\x09\x0B-\x0D]*(?:\n|\z)"
BULLET = r"(?:\A|\n)[\x20\x09\x0B-\x0D]*[-*\x{2022}][\x20\x09]"


@dataclass(frozen=True)
class Rule:
    """Rejects a text by ``test``, a SQL condition over the measures named in ``needs``."""

    name: str
    needs: tuple[str, ...]
    test: str

    def rejects(self) -> Column:
        return F.expr(self.test)


RULES = (
    Rule("few_words", ("n_words",), "n_words < 10"),
    Rule("repeated_words", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), "10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", ("n_words", "word_chars"), "word_chars < 2 * n_words"),
    Rule("long_words", ("n_words", "word_chars"), "word_chars > 20 * n_words"),
    Rule("ellipses", ("n_lines", "n_ellipsis_lines"), "n_lines >= 5 AND 10 * n_ellipsis_lines > 3 * n_lines"),
    Rule("bullets", ("n_lines", "n_bullet_lines"), "n_lines >= 5 AND 10 * n_bullet_lines > 9 * n_lines"),
)


def prepared(docs: DataFrame, text: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """``extra`` columns as they are (``in_0``, ``in_1``, ...), with the text and its words."""
    kept = [column(c).alias(f"in_{i}") for i, c in enumerate(extra)]
    rows = docs.select(*kept, whole(text).alias("body"))
    return rows.select("*", space_words(F.col("body")).alias("words"))


def with_repeats(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside windows that stand twice or more in the text.

    Windows are compared by a 64-bit hash. Sorting them puts equal ones side by side; texts
    without equal windows, which are most, skip that.
    """
    rows = window_hashes(rows, "words", WINDOW, "windows")
    placed = F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    unique = F.size(F.array_distinct("windows")) == F.size("windows")
    rows = rows.select("*", F.when(~unique, placed).alias("placed"))

    def twice(j):
        here = F.get("placed", j)["h"]
        near = (here == F.get("placed", j - 1)["h"], here == F.get("placed", j + 1)["h"])
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    at = F.filter(F.sequence(F.lit(0), F.size("placed") - 1), twice)
    rows = rows.select("*", F.when(F.col("placed").isNotNull(), at).alias("at"))
    starts = F.sort_array(F.transform("at", lambda j: F.get("placed", j)["i"]))
    rows = rows.select("*", starts.alias("starts"))
    total = F.coalesce(covered(F.col("starts"), F.lit(WINDOW).cast("long")), F.lit(0).cast("long"))
    # As a generator's output the measure is no alias that a filter on it could be pushed through;
    # the filter would otherwise be computed from the words once more, for every reference.
    rows = rows.select("*", F.explode(F.array(total)).alias("n_repeat_words"))
    return rows.drop("windows", "placed", "at", "starts")


def with_lines(rows: DataFrame) -> DataFrame:
    """Adds ``n_lines`` (lines with a word) and ``n_dup_lines`` (equal to an earlier one)."""
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("*", lines.alias("lines"))
    n = F.size("lines").cast("long")
    again = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    return rows.select("*", n.alias("n_lines"), again.alias("n_dup_lines")).drop("lines")


def counted(pattern: str, body: Column) -> Column:
    return F.regexp_count(body, F.lit(pattern)).cast("long")


#: Measures that only rules need; null for a null ``body``, without work.
LAZY = {
    "n_ellipsis_lines": lambda body: counted(ELLIPSIS, body),
    "n_bullet_lines": lambda body: counted(BULLET, body),
}

#: How each measure is added to rows that have ``body`` and ``words``.
MEASURES = {
    "n_words": lambda rows: rows.withColumn("n_words", F.size("words").cast("long")),
    "word_chars": lambda rows: rows.withColumn(
        "word_chars", F.char_length(F.array_join("words", "")).cast("long")
    ),
    "n_symbols": lambda rows: rows.withColumn(
        "n_symbols", counted(SYMBOLS, F.col("body"))
    ),
    "n_lines": with_lines,
    "n_dup_lines": with_lines,
    "n_repeat_words": with_repeats,
}


def measured(rows: DataFrame, names=tuple(MEASURES)) -> DataFrame:
    for name in names:
        if name in LAZY:
            rows = rows.withColumn(name, LAZY[name](F.col("body")))
        elif name not in rows.columns:
            rows = MEASURES[name](rows)
    return rows


def _seconds(job) -> float:
    """Time of the second run: the first one also generates code."""
    job()
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def ranked(sample: DataFrame, rules=RULES) -> list[Rule]:
    """The rules by texts rejected per second among those that the rules before leave, measured on
    ``sample`` (``prepared`` rows). Where none rejects any more, the cheaper one comes first."""
    idle = _seconds(lambda: sample.agg(F.count_if(F.size("words") >= 0)).first())
    cost = {
        rule.name: max(1e-4, _seconds(lambda r=rule: measured(sample, r.needs).agg(F.count_if(r.rejects())).first()) - idle)
        for rule in rules
    }
    needs = tuple(dict.fromkeys(name for rule in rules for name in rule.needs))
    verdicts = F.array(*(rule.rejects() for rule in rules))
    patterns = measured(sample, needs).groupBy(verdicts.alias("by")).agg(F.count(F.lit(1)).alias("n"))
    left = [(dict(zip((r.name for r in rules), p["by"])), p["n"]) for p in patterns.collect()]  # within the sample
    found, rest = [], list(rules)
    while rest:
        rejected = {r.name: sum(n for by, n in left if by[r.name]) for r in rest}
        rest.sort(key=lambda r: (-rejected[r.name] / cost[r.name], cost[r.name]))
        found.append(rest.pop(0))
        left = [(by, n) for by, n in left if not by[found[-1].name]]
    return found


def order_rules(docs: DataFrame, text: str = "text", rules=RULES, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES):
    """Order for ``docs``, from the first ``rows`` rows of at most ``most`` bytes, so what the driver
    holds is bounded; the sample decides on time, not results."""
    if len(rules) < 2:
        return list(rules)
    some = docs.select(whole(text).alias("text")).where(F.octet_length("text") <= most).take(rows)
    return ranked(prepared(docs.sparkSession.createDataFrame(some, "text string")), rules)


def assess(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """The measures of ``MEASURES`` of every text, and whether the cascade keeps it.

    Those measures are asked for; the ones of ``LAZY`` are taken where no rule before has rejected.
    """
    rows = measured(prepared(docs, text, (doc_id,))).withColumn("rejected", F.lit(False))
    for rule in order_rules(docs, text, rules):
        for name in (n for n in rule.needs if n in LAZY):
            rows = rows.withColumn(name, LAZY[name](F.when(~F.col("rejected"), F.col("body"))))
        rows = rows.withColumn("rejected", F.col("rejected") | F.coalesce(rule.rejects(), F.lit(False)))
    return rows.select(F.col("in_0").alias("doc_id"), *MEASURES, (~F.col("rejected")).alias("kept"))


def keep(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns as they are.

    A measure is taken only when its rule comes up, and only of rows that are left by then.
    """
    rows = prepared(docs, text, tuple(docs.columns))
    for rule in order_rules(docs, text, rules):
        rows = measured(rows, rule.needs).where(~rule.rejects())
    return rows.select(*(F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = assess(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (F.col("kept") & ~failed).alias("kept"),
    )


_LINES = "list_filter(string_split(b, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))"

OP7_SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS b FROM documents
), w AS (
  SELECT k, doc_id, b,
    list_filter(regexp_split_to_array(b, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    {_LINES} AS l
  FROM t
), x AS (
  SELECT k, unnest(w) AS x, unnest(range(0, len(w))) AS p FROM w
), g AS (
  SELECT k, p, lead(x, {WINDOW - 1}) OVER o IS NOT NULL AS full_window,
    concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS g
  FROM x WINDOW o AS (PARTITION BY k ORDER BY p)
), h AS (
  SELECT k, p, count(*) OVER (PARTITION BY k, g) AS c FROM g WHERE full_window
), r AS (
  SELECT k, count(DISTINCT q) AS n
  FROM (SELECT k, unnest(range(p, p + {WINDOW})) AS q FROM h WHERE c > 1) GROUP BY k
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(b) - length(regexp_replace(b, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(regexp_extract_all(b, '{ELLIPSIS}')) AS n_ellipsis_lines,
    len(regexp_extract_all(b, '{BULLET}')) AS n_bullet_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > 3 * n_words
    OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR (n_lines >= 5 AND (10 * n_ellipsis_lines > 3 * n_lines OR 10 * n_bullet_lines > 9 * n_lines))) AS kept
FROM m
"""
