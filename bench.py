"""

1. ``load_raw_zone``: derive the 13 raw tables from the driver Parquet and
   write them as catalog tables under the shared checkpoint folder (the
   reference's bulk COPY INTO step); facts are bucketed by their key so the
   dedup window and duplicate checks need no fact shuffle.
2. Each headline query runs over that raw zone into the ``noop`` sink: one
   warm-up, then the median of three runs.

3. Loads and publishing, which write files, run once each over the driver data.

Prints one JSON line.  Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.plans import ingest_queries  # noqa: E402
from ledgerlake.registry import QUERIES  # noqa: E402
from ledgerlake.session import build_session, scratch_path  # noqa: E402
from ledgerlake.sources.zone import RawZone  # noqa: E402

HEADLINE = ["rpt_sales_master", "rpt_online_master", "clean_sales", "orphan_key_audit",
            "revenue_bridge_sales", "revenue_reconciliation", "placeholder_inventory_raw"]

WRITING = ["csv_load_pattern", "incremental_file_load", "publish_rpt_sales"]


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app="ledgerlake-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})

    zone_path = scratch_path(spark, "bench-raw-zone")
    derived = RawZone.from_driver(spark, sf_dir)
    sizes: dict = {}
    load_s = timed(lambda: sizes.update(derived.write_tables("ledgerlake_raw", zone_path, cpus)))
    zone = RawZone.from_catalog(spark, "ledgerlake_raw", sizes)

    times: dict[str, float] = {}
    for name in HEADLINE:
        def run():
            QUERIES[name](zone).write.format("noop").mode("overwrite").save()
        run()                                           # warm-up
        times[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)

    total = round(sum(times.values()), 3)
    once = {name: round(timed(lambda: ingest_queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()), 3)
            for name in WRITING}
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": total,
        "unit": "sec",
        "queries": {**times, "load_raw_zone": round(load_s, 3), **once},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "config": {"master": f"local[{cpus}]", "shuffle_partitions": cpus,
                   "spark": spark.version, "runs": runs, "sink": "noop"},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
