"""Time the headline operations and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores, BENCH_RUNS how
often each operation is timed after one warm-up run (the median counts), BENCH_QUERIES a
comma separated choice of registered queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from docharbor.catalog import QUERIES, run
from docharbor.session import local_session

HEADLINES = [
    "merge_upsert",
    "merge_emplace",
    "merge_insert_only",
    "append_row_ids",
    "dedup_last_wins",
    "merge_id_lines",
    "merge_id_text",
    "nested_children",
    "nested_grandchildren",
    "orphan_stale_rows",
    "orphan_cleanup_result",
    "decimal_text_to_int",
    "decimal_to_float",
    "epoch_int64",
    "variant_split",
    "state_newest_committed",
    "incremental_boundary",
    "sort_page",
    "load_upsert",
    "load_nested_with_cleanup",
    "sync_incremental",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    if chosen == "all":
        names = list(QUERIES)
    conf = {"spark.log.level": "ERROR"}
    if not os.environ.get("BENCH_SHARED_DIR"):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="run-")
    else:
        conf["spark.checkpoint.dir"] = os.environ["BENCH_SHARED_DIR"]
    spark = local_session("bench", cores=cpus, **conf)
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            run(name, spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
