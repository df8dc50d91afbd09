"""Words of a text as arrays, with built-in functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. A text of ASCII only takes the fast way."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(only_ascii, F.lower(text)).otherwise(slow)


def space_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def alnum_words(text: Column) -> Column:
    """Runs of 0-9, a-z and characters beyond ASCII of the text in ASCII lower case."""
    return F.array_remove(F.split(ascii_lower(text), NOT_ALNUM), "")


def column(name: str) -> Column:
    """A column by its name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole(text: str) -> Column:
    """The text of a row; a null text is empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def covered(starts: Column, length: Column) -> Column:
    """Places inside the union of spans ``[start, start + length)``, starts in rising order.

    ``length`` is one for all starts.
    """
    begin = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(acc, start):
        end = start.cast("long") + length
        return F.struct(
            end.alias("end"), (acc["total"] + F.least(length, end - acc["end"])).alias("total")
        )

    return F.aggregate(starts, begin, add)["total"]


def _later(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _rolled(df: DataFrame, values: str, size: int, name: str, merge) -> DataFrame:
    """Fold ``size`` neighbours of an array by doubling: a few passes instead of a slice for every
    place. Every pass is a column of its own, so none is computed twice."""
    temporary, done, part, width = [], 0, values, 1
    acc = None
    while True:
        if size & width:
            if acc is None:
                acc = part
            else:
                step = f"_{name}_{len(temporary)}"
                df = df.select(
                    "*", F.zip_with(acc, _later(F.col(part), done), merge).alias(step)
                )
                temporary.append(step)
                acc = step
            done += width
        if done == size:
            break
        step = f"_{name}_{len(temporary)}"
        df = df.select("*", F.zip_with(part, _later(F.col(part), width), merge).alias(step))
        temporary.append(step)
        part, width = step, 2 * width
    count = F.greatest(F.size(values) - (size - 1), F.lit(0))
    whole = F.slice(acc, F.lit(1), count) if size > 1 else F.col(acc)
    return df.select("*", whole.alias(name)).drop(*temporary)


def window_hashes(df: DataFrame, words: str, size: int, name: str) -> DataFrame:
    """Adds the 64-bit hashes of all windows of ``size`` words, in order; none if there are fewer
    words. Column names beginning with an underscore are taken."""
    df = df.select("*", F.transform(words, lambda x: F.xxhash64(x)).alias(f"_{name}"))
    return _rolled(df, f"_{name}", size, name, lambda a, b: F.xxhash64(a, b)).drop(f"_{name}")


def window_minima(df: DataFrame, values: str, size: int, name: str) -> DataFrame:
    """Adds the least value of every ``size`` neighbours; none if there are fewer values."""
    return _rolled(df, values, size, name, lambda a, b: F.least(a, b))
