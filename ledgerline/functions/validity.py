"""First verdict on a raw row. Flag and reasons follow their own tests and can disagree: a valid
row may carry a reason. Both are kept as they are."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as C
from .text import is_blank


def validity_flag(patent_id: Column, has_fulltext: Column, publish_file: Column) -> Column:
    bad = (
        is_blank(patent_id)
        | has_fulltext.isNull()
        | (has_fulltext == "0")
        | publish_file.isNull()
    )
    return F.when(bad, 0).otherwise(1)


def validity_reason(patent_id: Column, has_fulltext: Column, publish_file: Column) -> Column:
    flag = F.trim(has_fulltext)
    return F.concat_ws(
        ";",
        F.when(is_blank(patent_id), C.REASON_ID_BLANK),
        F.when(is_blank(has_fulltext) | (flag == "0"), C.REASON_NO_FULLTEXT),
        F.when((flag == "1") & is_blank(publish_file), C.REASON_NO_FILE),
    )
