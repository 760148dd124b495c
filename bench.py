"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR on local[$BENCH_CPUS]. Every query runs whole, into a sink
that drops the rows; the value is the sum of the best of two runs after one to
warm up. The first run of a link query also builds the fixture of links from all line items.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogsync.session import build_session  # noqa: E402
from checks.compare import LOCAL  # noqa: E402
from checks.queries import registry  # noqa: E402

QUERIES = [
    "live_products", "merge_product_feeds", "categories_status", "issues_categories", "products_new",
    "products_vitals", "products_inactive", "products_info", "issues_products", "allocate_ids", "apply_products",
    "first_wins", "import_links", "links_dropped", "links_added", "assign_master", "patch_vitals", "patch_status_list", "clean_text",
    "media_keep_largest", "media_new", "media_candidates", "media_manifest", "changed_sources", "read_feed_complete", "run_patch",
    "replay_snapshots",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", {**LOCAL, "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registry(), {}
    for name in QUERIES:
        best = float("inf")
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "catalogue reconciliation, sum over queries",
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
