"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (no collection to
the driver): one warm-up run, then the median of three timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skywarden.plans import catalog  # noqa: E402
from skywarden.session import build_session  # noqa: E402

HEADLINE = [
    "indicators_all",        # logs x blacklist -> 16 indicators, one pass
    "tagged_requests",       # row-level join + tags
    "etl_processed",         # full stream-ETL function on raw lines
    "ip_window_metrics",     # 7 per-IP window metrics
    "blacklist_rows",        # metrics -> flow scores -> blacklist
    "mask_id",               # masking over whole documents
    "server_three_day",      # calendar window over daily counts
    "scored_indicators",     # all three paths chained: ETL -> scores -> blacklist -> indicators
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in catalog.QUERIES]
    spark = build_session(f"local[{cpus}]", app="skywarden-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false",
                                 "spark.driver.memory": "16g"})
    out = {}
    for name in names:
        fn = catalog.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
            if os.environ.get("BENCH_VERBOSE"):
                print(name, round(times[-1], 3), file=sys.stderr, flush=True)
        out[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
