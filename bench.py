"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of local threads.
Every query runs in full and all of its columns are computed (``noop`` sink). The first query
runs twice and counts once, so that starting the engine is not measured.
"""

from __future__ import annotations

import json
import os
import re
import time

from ledgerline.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "raw_lineage", "validity_flags", "date_normalize", "multi_value", "object_path",
    "legal_status_map", "language_map", "standardize_full", "assign_ids", "path_prune",
    "dedup_flag", "region_fix", "clean_full", "split_valid", "split_invalid", "final_valid",
    "final_invalid", "merge_partitions", "refresh_in_stock", "file_audit", "conservation",
    "csv_round_trip", "ingest_resume", "default_steps",
]


def run(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(f"local[{CPUS}]")
    from ledgerline.queries import QUERIES

    run(QUERIES[HEADLINE[0]], spark)
    times = {key: run(QUERIES[key], spark) for key in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
