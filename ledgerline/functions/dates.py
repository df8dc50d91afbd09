"""Dates written in many shapes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as C

# Tail of a date that a clock time (also a cut one, such as "8:05") may follow.
_CLOCK_TAIL = r"( *|  *([01]?[0-9]|2[0-3])(:|:[0-5]?[0-9]:?|:[0-5]?[0-9]:[0-5]?[0-9].*)?)"


def normalize_date(c: Column) -> Column:
    """Date from `yyyyMMdd`, `yyyy-MM-dd...`, `y-M-d` with an optional time, epoch seconds or
    epoch milliseconds. `/` counts as `-` and `T` as a space. Anything else, zero dates and
    impossible dates give NULL. Epochs fall on the day of the session time zone.
    """
    text = F.trim(c)
    plain = F.replace(F.replace(text, F.lit("/"), F.lit("-")), F.lit("T"), F.lit(" "))
    day = F.left(plain, F.lit(10))
    digits = F.regexp_replace(text, "^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    return (
        F.when(text.isin(*C.ZERO_DATES), None)
        .when(text.rlike("^[0-9]{8}$"), _day(F.left(digits, F.lit(10))))
        .when(day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), _day(day))
        .when(
            plain.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}" + _CLOCK_TAIL + "$"),
            _day(F.substring_index(plain, " ", 1)),
        )
        .when(text.rlike("^[0-9]{10}$"), _day_of_epoch(F.left(text, F.lit(10))))
        .when(text.rlike("^[0-9]{13}$"), _day_of_epoch(F.left(text, F.lit(10))))
    )


def _day(text: Column) -> Column:
    """Date of text whose shape is known; a cast is several times faster than a format parser."""
    return text.try_cast("date")


def _day_of_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.try_cast("bigint")).cast("date")
