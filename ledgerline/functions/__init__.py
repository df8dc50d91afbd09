"""Column rules: every function takes and returns a Column and stays in the JVM."""

from .dates import normalize_date
from .paths import clean_path, prune_paths
from .region import application_origin, merge_home_country, integer_text, province_without_pct
from .text import (
    address_without_zip,
    append_reason,
    blank_to_null,
    first_of_list,
    fulltext_flag,
    is_blank,
    megabytes,
    multi_value,
    number_without_country,
    object_path,
    type_code,
    unclassified_if_design,
    upper_or_null,
    year_of,
    zip_of_address,
)
from .validity import validity_flag, validity_reason
from .wide import in_small_methods

__all__ = [
    "address_without_zip", "append_reason", "application_origin", "blank_to_null", "clean_path",
    "first_of_list", "fulltext_flag", "in_small_methods", "integer_text", "is_blank", "megabytes",
    "merge_home_country", "multi_value", "normalize_date", "number_without_country",
    "object_path", "province_without_pct", "prune_paths", "type_code", "unclassified_if_design",
    "upper_or_null", "validity_flag", "validity_reason", "year_of", "zip_of_address",
]
