"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from . import constants as C

INGEST_MODES = ("full", "resume", "rerun_failed")
STAGE_MODES = ("new", "all_not_success", "retry_failed")
CLEAN_RULES = ("path", "dedup", "region")


def default_batch_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("batch_%Y%m%d_%H%M%S")


@dataclass(frozen=True)
class Params:
    """One partition of the data and how to run it. Table names are folders below ``root``."""

    root: str = ""
    table_id: str = "a"
    batch_id: str = field(default_factory=default_batch_id)
    data_source: str = "A"
    ods_table: str = ""
    stage_table: str = ""
    valid_table: str = ""
    invalid_table: str = ""
    final_valid_table: str = "final_valid"
    final_invalid_table: str = "final_invalid"
    file_log: str = "ods_file_load_log"
    bad_records: str = "ods_bad_records"
    done_log: str = "stage_file_done"
    run_log: str = "run_log"
    mode: str = "all_not_success"
    delete_before_insert: bool = True
    max_files: int | None = None
    start_after: tuple[str, ...] = ()
    rules: tuple[str, ...] = CLEAN_RULES
    duplicate_reason: str = C.REASON_DUPLICATE
    default_user: str = C.DEFAULT_USER
    min_key: int | None = None
    run_ts: datetime = field(default_factory=datetime.now)

    def __post_init__(self):
        if self.mode not in STAGE_MODES:
            raise ValueError(f"mode must be one of {STAGE_MODES}, not {self.mode!r}")
        unknown = set(self.rules) - set(CLEAN_RULES)
        if unknown:
            raise ValueError(f"unknown clean rules {sorted(unknown)}; known: {CLEAN_RULES}")
        for name, stem in (
            ("ods_table", "ods_raw"),
            ("stage_table", "stage"),
            ("valid_table", "in_stock"),
            ("invalid_table", "unqualified"),
        ):
            if not getattr(self, name):
                object.__setattr__(self, name, f"{stem}_{self.table_id}")
