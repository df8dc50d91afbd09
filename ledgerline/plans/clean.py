"""Stage rules: path pruning, repeated ids, region. They touch valid rows only and drop none."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as C, functions as G
from ..operators.dedup import flag_duplicates
from ..params import Params
from ..sources.dictionaries import Dictionaries


def clean_paths(
    stage: DataFrame,
    min_key: int | None = None,
    guarded: bool = True,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Prune classification paths, optionally only of rows after ``min_key``."""
    name = F.col("intci_main_name")
    new = G.clean_path(name, F.col("is_valid"), guarded)
    if min_key is not None:
        new = F.when(F.col("stage_id") > min_key, new).otherwise(name)
    if run_ts is None:
        return stage.withColumn("intci_main_name", new)
    # In two steps, so that the new path is computed once.
    rows = stage.withColumn("_path", new)
    return _touch(rows, {"intci_main_name": F.col("_path")}, run_ts).drop("_path")


def fix_region(
    stage: DataFrame, dicts: Dictionaries, run_ts: datetime | None = None
) -> DataFrame:
    """Province from the country dictionary, PCT province, home country, signory item, origin.

    Each rule sees the result of the one before.
    """
    valid = F.col("is_valid") == 1
    country, province = F.col("appl_country"), F.col("appl_province")
    abroad = F.collate(country, C.COUNTRY_COLLATION) != F.lit(C.COUNTRY_HOME)
    fill = abroad & G.is_blank(province) & F.col("_country_hit")
    filled = F.when(fill, F.col("_country_name")).otherwise(province)
    home = G.merge_home_country(country)
    new = {
        "appl_province": G.province_without_pct(country, filled),
        "appl_country": home,
        "signory_item": G.integer_text(F.col("signory_item")),
        "application_origin": G.application_origin(home),
    }
    new = {n: F.when(valid, value).otherwise(F.col(n)) for n, value in new.items()}
    rows = dicts.with_country(stage, "appl_country")
    rows = rows.withColumns(new) if run_ts is None else _touch(rows, new, run_ts)
    return rows.select(*stage.columns)


def _touch(rows: DataFrame, new: dict[str, Column], run_ts: datetime) -> DataFrame:
    """Set columns, and ``updated_date`` where one of them changes."""
    same = F.lit(True)
    for name, value in new.items():
        same = same & value.eqNullSafe(F.col(name))
    moved = F.when(same, F.col("updated_date")).otherwise(F.lit(run_ts))
    return rows.withColumns({**new, "updated_date": moved})


def clean(
    stage: DataFrame, dicts: Dictionaries, params: Params, keep: DataFrame | None = None
) -> DataFrame:
    """All rules named in ``params.rules``; ``updated_date`` moves on changed rows only. ``keep``: the
    repeated ids, where they are known."""
    rows = stage
    if "path" in params.rules:
        rows = clean_paths(rows, params.min_key, run_ts=params.run_ts)
    if "dedup" in params.rules:
        rows = flag_duplicates(rows, reason=params.duplicate_reason, run_ts=params.run_ts, keep=keep)
    if "region" in params.rules:
        rows = fix_region(rows, dicts, params.run_ts)
    return rows


def restore_raw(stage: DataFrame) -> DataFrame:
    """Put the raw classification name back on valid rows that have one."""
    raw = F.col("intci_name_raw")
    back = (F.col("is_valid") == 1) & (raw != "")
    return stage.withColumn(
        "intci_main_name", F.when(back, raw).otherwise(F.col("intci_main_name"))
    )
