"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query's result is forced with the ``noop`` sink (full computation, no output
cost). One warm-up pass over all queries, then the median of ``$BENCH_REPEATS``
(default 3) timed runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from verbscope.plans.catalog import QUERIES  # noqa: E402
from verbscope.session import get_spark  # noqa: E402

HEADLINE = (
    "que_rate_by_lang", "normalize_text", "dedup_first", "merge_pull", "duplicate_report",
    "registry_kept", "query_match", "annotate", "process_batch", "verb_runs", "verb_distance",
    "mark_heads", "verb_type_counts", "top_tokens", "pos_pairs", "page_batches", "assign_ids", "batches",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    for n in names:  # warm-up: JIT, file listing, Python workers
        run(QUERIES[n](spark, sf))
    times = {}
    for n in names:
        ts = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run(QUERIES[n](spark, sf))
            ts.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(ts), 3)
    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(os.path.normpath(sf)).replace("sf", "")
    print(json.dumps({"metric": "total_median_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": sf_name, "cpus": int(cpus), "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
