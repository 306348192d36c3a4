"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, to time others than the headline ones
"""

from __future__ import annotations

import json
import os
import sys
import time

from quarrylake.queries import QUERIES
from quarrylake.session import build_session

HEADLINE = (
    "csv_scan", "csv_drift", "ndjson_scan", "document_envelope", "xml_scan", "parquet_merge",
    "partitioned_sink", "incremental_load", "mixed_timestamps", "unit_normalise", "minor_units",
    "fk_split", "validity_split", "membership_flag", "redact_by_key", "latest_per_key", "distinct_rows",
    "one_per_key", "scd2_snapshot", "scd2_changes", "scd2_changes_hot", "date_dim", "time_dim", "junk_dim",
    "silver_riders", "silver_vehicles", "silver_rides", "silver_payments", "silver_telemetry",
    "gold_vehicles", "gold_riders",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scd2_snapshot"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
