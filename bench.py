"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores. Every query runs once untimed on the
smallest tables next to the folder, if they are there, so that class loading is not part of the first timing; each is
then timed once, from building its plan to the last row written to a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from abasto.session import local_session  # noqa: E402
from abasto.workload import queries_layers, queries_reports  # noqa: E402, F401  (registers the queries)
from abasto.workload.registry import QUERIES  # noqa: E402

HEADLINE = (
    "silver_receipts silver_requests norm_requests norm_receipts gold_supplier_metrics gold_monthly_demand "
    "quality_profile dup_full_rows redundancy_match integrity_orphans norm_null_fks reconcile_demand reconcile_metrics "
    "rep_kpis rep_receipts_monthly rep_top_items rep_top_suppliers rep_product_share rep_recent_receipts "
    "fc_linear_trend fc_seasonal_trend fc_lag_features fc_autoregressive fc_allocate_top15"
).split()


def run(name: str, spark, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cores, shuffle_partitions=8, memory="16g")
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            run(name, spark, small)
    seconds = {name: round(run(name, spark, folder), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
