"""Headline queries, each run twice; the second run counts.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import REGISTRY  # noqa: E402
from offerwise.session import local_session  # noqa: E402

HEADLINE = (
    "unit_prices__P7",
    "campaign_window_join__J5",
    "customer_summary__A1",
    "trip_change__V1",
    "coupon_share_wk__V5",
    "sp_qty_mean_all__V12",
    "coupon_rate_by_category__V24",
    "last_sp_qty__L6",
    "usual_items__A7a",
    "offer_table__E2",
    "coupon_table__C4",
    "contiguous_folds__W6_M2",
    "fold_auc__M5",
    "customer_table__E1",
    "training_table__E2",
)
# A learner run is kept for the session, so its first run counts; the training table and matrix are made before it.
LEARNER = ("feature_matrix__M1", "train_fold__M3")


def run(spark, folder: str, name: str) -> float:
    started = time.time()
    REGISTRY[name][0](spark, folder).write.format("noop").mode("overwrite").save()
    return time.time() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count())))
    wanted = sys.argv[1:] or (*HEADLINE, LEARNER[1])
    spark = local_session("bench", cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        if name in LEARNER:
            run(spark, folder, LEARNER[0])
            seconds[name] = round(run(spark, folder, name), 3)
            print(f"{name}: {seconds[name]:.2f}s", file=sys.stderr, flush=True)
            continue
        first = run(spark, folder, name)
        seconds[name] = round(run(spark, folder, name), 3)
        print(f"{name}: first {first:.2f}s, second {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "seconds for all headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
