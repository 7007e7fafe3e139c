"""Wall time of the headline queries: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_WARMUP_DIR
(default /root/testdata/sf0.01; "" disables).

Each query is first run untimed on the small warm-up tables (JIT, analyzer
and Python-worker start-up), then timed on BENCH_SF_DIR from plan
construction to the end of execution.  Nothing is cached between the two.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "t1_time_stats",
    "f7_window_features",
    "w3_rolling_stats",
    "d1_stratified_split",
    "a4_describe",
    "c1_correlation",
    "c4_anova_f",
    "e5_average_metrics",
    "e7_roc_auc",
    "x6_ab_result",
    "r8_early_stop",
    "m1_random_forest",
    "m2_boosted_trees",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from strideframe.plans.catalog import all_queries
    from strideframe.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2))
    qs = all_queries()
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else [n for n in HEADLINE if n in qs]
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01").rstrip("/")
    if warm and os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in names:
            qs[name].run(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        # timed from plan construction: some operators run a fit (a distributed
        # aggregate whose small result parameterises the plan) while building
        t0 = time.time()
        df = qs[name].run(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_total_wall",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
