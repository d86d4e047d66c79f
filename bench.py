"""Headline queries, timed. Prints one JSON line.

The landed inputs (raw JSON listings and messages derived from the given tables) are written first and reported apart,
since a production feed is landed by its source. Every query then runs in full into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stratafile.plans import inputs  # noqa: E402
from stratafile.plans.queries import QUERIES  # noqa: E402
from stratafile.session import local_session  # noqa: E402

HEADLINE = [
    "P01_normalize_files", "P16_render_text", "P17_metadata", "Q01_fetch_files", "S01_list_pages", "P02_revisions",
    "N06_last_revisions", "P04_comments", "S02_change_feed", "Q12_incremental", "Q13_webhook_changes", "N08_latest_change",
    "A04_sync_progress", "T01_routes", "K02_api_errors", "N07_dedup", "T02_ttl_dedup", "K03_blob_index",
    "K04_offload_split", "A08_latency", "N09_failure_streaks", "T08_quota", "K05_state_upsert", "W01_file_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores)
    start = time.perf_counter()
    for land in (
        inputs.raw_files, inputs.webhook_messages, inputs.command_messages, inputs.raw_revisions, inputs.raw_comments,
        inputs.write_commands,
    ):
        land(spark, sf_dir)
    landing = time.perf_counter() - start
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    files = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "landing_sec": round(landing, 3),
                "files": files,
                "files_per_sec_normalized": round(files / times["P01_normalize_files"], 1)
                if "P01_normalize_files" in times
                else None,
            }
        )
    )


if __name__ == "__main__":
    main()
