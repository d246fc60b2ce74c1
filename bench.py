"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Each
query is run once to warm up, then three times; its time is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from linkloom.catalog import QUERIES
from linkloom.runtime import local_session

HEADLINE = (
    "ranking_job", "top_n_pages", "sum_by_title", "parse_dump_tuples", "semi_by_title", "dump_job",
    "write_filtered_dump", "min_links", "link_counts", "union_link_families", "dedupe_cells", "inject_zeros",
    "batch_merged", "read_coo", "fit_embeddings", "loss_history", "semi_by_title_large", "gather_factors_large",
    "first_project_run", "entity_job",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(took[1:]), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
