"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and executed in full (``noop`` sink, so nothing is
collected): one warm-up, then the median of three runs (one run if the warm-up
took longer than 20 seconds).  Prints one JSON line.  ``BENCH_QUERIES`` (comma list) overrides the set; ``BENCH_RUNS`` the
number of timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_features", "customer_rfm", "customer_lifetime_value", "order_summary",
    "customer_summary", "churn_training_set", "purchase_summary", "revenue_by_day",
    "cohort_retention", "return_drivers", "auc_from_scores", "gamma_gamma_fit",
    "churn_scores", "churn_logreg", "churn_risk_bands", "bgnbd_fit", "median_fill", "ltv_bucket_box",
    "retention_survival", "return_rules", "clv_holdout", "bootstrap_effect",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from basketry.plans.queries import REGISTRY
    from basketry.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "8")))
    times: dict[str, float] = {}
    for name in names:
        fn = REGISTRY[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        first = once()
        times[name] = round(statistics.median(once() for _ in range(runs if first < 20 else 1)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
