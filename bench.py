"""Headline queries at one scale factor; prints one JSON line.

Each query runs once to warm up and then RUNS times; the median counts. Results are consumed with the ``noop``
sink, so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "dml00_mixed_changes", "dml01_upsert", "dml01b_upsert_lineitem", "dml01c_upsert_lineitem_table", "dml08_log_replay", "dml10_snapshot_compare", "snk01_keyed_table",
    "nst01_flatten", "nst04_parent_and_child", "nst07_child_tree", "hsh01_row_hash", "hsh02b_row_id_lineitem", "hsh06_generated_key",
    "jon06_edges", "jon10_compare_hashes", "agg06_merge_counts", "agg07_latest_fact", "agg17_assemble",
    "win01_keep_first", "win03_chunk_bounds", "win04_pages", "win06_versions", "inc04_keyset", "inc08_mark_per_parent",
    "inc16_resume_after_cap", "dq01_typed_rows", "src02_typed_pruned", "src05_parquet_export", "src10_interval",
    "str01_queue_drain", "str06_stepped_series", "udf02_budgeted_score", "udf03_consensus", "txt10_sections",
]
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", cores=cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cores": cores, "runs": RUNS}))


if __name__ == "__main__":
    main()
