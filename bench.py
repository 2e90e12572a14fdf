"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default the headline set).
Each query is planned and run to completion into a sink that discards rows. The total is
that of the lazy path; `materialise` and the queries on stored layers stand beside it.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from arrearlens import get_session
from arrearlens.plans.book import materialise
from arrearlens.plans.report import dq_report
from showcase.queries import book, queries

HEADLINE = (
    "monthly_kpis",
    "clean_calls",
    "clean_payments",
    "clean_dq_account_borrower_conflicts",
    "clean_quarantine_orphans",
    "gold_account_month",
    "features_enriched",
    "metrics_monthly",
    "ops_monthly",
    "channel_14d",
    "channel_yield",
    "attribution_sensitivity",
    "touch_multiplicity",
    "call_hour_contact",
    "agent_tenure",
    "vendor_stability",
    "targeted_vs_never",
    "driver_state",
    "mix_decomposition",
    "borrower_asof",
    "experiment_readout",
    "dq_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = queries()

    def timed(name: str) -> float:
        started = time.perf_counter()
        run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    timed("stg_accounts")  # start the JVM's code paths outside the measurement
    seconds = {name: timed(name) for name in names}
    stored = {}
    if "BENCH_QUERIES" not in os.environ:
        layers = book(spark, sf_dir)
        with tempfile.TemporaryDirectory() as root:
            started = time.perf_counter()
            materialise(layers, spark, root)
            stored["materialise"] = round(time.perf_counter() - started, 3)
            runs = {"gold_account_month": layers.gold, "features_enriched": layers.enriched, "metrics_monthly": layers.monthly, "dq_report": lambda: dq_report(layers)}
            for name, build in runs.items():
                started = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                stored[name] = round(time.perf_counter() - started, 3)
    sf = re.search(r"sf([\d.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "stored": stored,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )


if __name__ == "__main__":
    main()
