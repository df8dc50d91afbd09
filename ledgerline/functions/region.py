"""Rules for country, province and signory item. They build on each other in a fixed order, see
``plans.clean.fix_region``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as C
from .text import is_blank


def province_without_pct(country: Column, province: Column) -> Column:
    return F.when(country == C.COUNTRY_PCT, None).otherwise(province)


def merge_home_country(country: Column) -> Column:
    return F.when(country.isin(*C.COUNTRIES_MERGED_HOME), C.COUNTRY_HOME).otherwise(country)


def application_origin(country: Column) -> Column:
    return (
        F.when(country == C.COUNTRY_PCT, C.ORIGIN_PCT)
        .when(country == C.COUNTRY_HOME, C.ORIGIN_DOMESTIC)
        .when(~is_blank(country), C.ORIGIN_FOREIGN)
    )


def integer_text(c: Column) -> Column:
    """`12.0` becomes `12`; other text stays, also a number too long for 20 digits."""
    text = F.trim(c)
    whole = text.try_cast("decimal(30,10)").cast("decimal(20,0)").cast("string")
    return F.when(text.rlike(r"^[0-9]+\.0+$"), F.coalesce(whole, c)).otherwise(c)
