"""Classification paths such as `A^x>A01^y$$$G^z`: one path per section is enough."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .. import constants as C

# All characters that count as white space at the ends of a part.
_EDGE = r"[\s\p{Z}\x1c-\x1f\x85]+"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_EDGE}|{_EDGE}$", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def _literal(mark: str) -> str:
    """Pattern of a mark. Java splits by one escaped sign without compiling a pattern for each row."""
    return rf"\{mark}" if re.fullmatch("[!-/:-@^_`{-~]", mark) else rf"\Q{mark}\E"


def _section(part: Column, level: str) -> Column:
    """First character of the code of the first level, without a code that level, without a level the part.

    The part has no white space in front, so what stands in front of a mark is empty only if the part
    begins with the mark, and otherwise begins as the part does.
    """
    head = strip(F.substring_index(part, level, 1))
    return (
        F.when(F.startswith(part, F.lit(level)), part)
        .when(F.startswith(part, F.lit(C.CODE_SEPARATOR)), head)
        .otherwise(F.left(part, F.lit(1)))
    )


def prune_paths(
    c: Column, separator: str = C.PATH_SEPARATOR, level: str = C.LEVEL_SEPARATOR
) -> Column:
    """Keep, for each section, the deepest path, then the longest, then the first.

    Sections stay in the order in which they first appear.
    """
    parts = F.filter(
        F.transform(F.split(c, _literal(separator)), strip), lambda part: part != ""
    )
    ranked = F.transform(
        parts,
        lambda part, i: F.struct(
            _section(part, level).alias("section"),
            F.size(F.split(part, _literal(level))).alias("depth"),
            F.length(part).alias("length"),
            (-i).alias("earlier"),
            part.alias("part"),
        ),
    )

    def best_per_section(rows: Column) -> Column:
        sections = F.array_distinct(F.transform(rows, lambda r: r["section"]))
        best = F.transform(
            sections,
            lambda s: F.array_max(F.filter(rows, lambda r: r["section"] == s))["part"],
        )
        return F.array_join(best, separator)

    return _let(ranked, best_per_section)


def clean_path(c: Column, is_valid: Column, guarded: bool = True) -> Column:
    """Pruned path for valid rows that hold more than one level or path, else the value itself.

    The new value counts only if it is not empty and differs from the stripped old value.
    ``guarded=False`` gives the earlier form of the rule: any different value counts, so outer
    white space goes as well.
    """
    several = F.contains(c, F.lit(C.PATH_SEPARATOR)) | F.contains(c, F.lit(C.LEVEL_SEPARATOR))
    pruned = F.when((is_valid == 1) & several, prune_paths(c))
    if not guarded:
        return F.coalesce(pruned, c)
    return _let(pruned, lambda new: F.when((new != "") & (new != strip(c)), new).otherwise(c))
