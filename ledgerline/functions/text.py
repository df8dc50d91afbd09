"""Rules for text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as C

# Java's \s leaves out the Unicode separators (U+3000, U+00A0, ...), so they are named as well.
SPACE = r"[\s\p{Z}]"


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def upper_or_null(c: Column) -> Column:
    return F.nullif(F.upper(F.trim(c)), F.lit(""))


def number_without_country(c: Column) -> Column:
    """Application number in upper case without a leading country code CN."""
    return F.nullif(F.regexp_replace(F.upper(F.trim(c)), "^CN", ""), F.lit(""))


def multi_value(c: Column, also: str = "") -> Column:
    """One spelling for lists: `;` between values, no space around it, blank as NULL.

    ``also`` holds further characters that separate values beside the comma.
    """
    text = F.trim(c)
    for mark in "," + also:
        text = F.replace(text, F.lit(mark), F.lit(";"))
    # Only marks that do have space beside them are replaced.
    return F.nullif(F.regexp_replace(text, f"{SPACE}+;{SPACE}*|;{SPACE}+", ";"), F.lit(""))


def unclassified_if_design(patent_type: Column, value: Column) -> Column:
    """Design patents carry a fixed mark in place of a classification."""
    return F.when(patent_type == C.DESIGN_PATENT, C.NOT_CLASSIFIED).otherwise(value)


def year_of(c: Column) -> Column:
    return F.left(c, F.lit(4))


def fulltext_flag(c: Column) -> Column:
    return F.when(F.trim(c) == "1", 1).when(F.trim(c) == "0", 0)


def _leads_with_zip(c: Column) -> Column:
    return c.rlike("^[0-9]{6}")


def address_without_zip(c: Column) -> Column:
    return F.when(_leads_with_zip(c), F.trim(F.substr(c, F.lit(7)))).otherwise(c)


def zip_of_address(c: Column) -> Column:
    return F.when(_leads_with_zip(c), F.left(c, F.lit(6))).otherwise("")


def first_of_list(c: Column) -> Column:
    return F.when(~is_blank(c), F.substring_index(c, ";", 1))


def object_path(base: Column, publish_file: Column, table_id: str) -> Column:
    """Path of the full text in the object store; NULL where no file is named."""
    name = publish_file
    if table_id == C.STRIPPED_PREFIX_TABLE:
        name = F.regexp_replace(name, f"(?i)^{C.STRIPPED_PREFIX}", "")
    return F.when(~is_blank(publish_file), F.concat(base, name))


def append_reason(reasons: Column, message: str) -> Column:
    """Add a message to a `;` list of reasons unless the list already holds it."""
    return (
        F.when(is_blank(reasons), F.lit(message))
        .when(F.contains(reasons, F.lit(message)), reasons)
        .otherwise(F.concat_ws(";", reasons, F.lit(message)))
    )


def type_code(main_code: Column) -> Column:
    """First three characters of the main classification code."""
    return F.coalesce(
        F.nullif(F.left(F.trim(main_code), F.lit(3)), F.lit("")), F.lit(C.TYPE_CODE_UNKNOWN)
    )


def megabytes(size: Column) -> Column:
    return F.round(size / 1024 / 1024, 3)
