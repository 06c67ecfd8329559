"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from mailtrail.queries import QUERIES
from mailtrail.session import engine_session

HEADLINE = [
    "record_validation_strict", "record_validation_lenient", "estadistica", "errores",
    "visitors_rebuild", "visitors_merged", "visitor_upsert_counts", "batch_reconciliation",
    "load_reconciliation", "file_disposition", "file_state_fold", "run_operational_summary",
    "file_operational_detail", "monthly_summary", "alert_messages", "append_without_duplicates",
    "constraint_violations", "scan_lines_numbered", "scan_csv_reports", "file_checksums",
    "archive_verification", "roundtrip_estadistica",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = engine_session(
        "bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
        **{"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["file_statuses"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
