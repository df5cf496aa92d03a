"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores.
Each query's whole result goes to Spark's no-op sink, so nothing is pruned away.
"""

from __future__ import annotations

import json
import os
import time

from meterline.plans.queries import queries
from meterline.session import local_session

HEADLINE = [
    "split_summary",
    "reject_waterfall",
    "feature_matrix",
    "zone_mean_metrics",
    "zone_join",
    "exact_sample",
    "bin_edges",
    "binned_counts",
    "grad_histogram",
    "root_split",
    "early_stop",
    "asha_survivors",
    "tpe_scores",
    "boost_stumps",
    "fit_hist",
    "fit_mllib",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    table = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        table[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("split_summary")  # session start-up is not a query's time
    seconds = {name: run(name) for name in HEADLINE}
    out = {
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
