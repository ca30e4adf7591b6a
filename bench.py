"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the local cores. Every result
is produced in full (written to the no-op sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "W2_stock_log_return", "J4_asof_forward", "V5_multi_window", "V6_wide_results", "V7_timeline", "V8_features",
    "A1_dedupe_most_complete", "A2_first_non_null", "A9_kde", "A10_box_stats", "S2_insert_only",
    "S3_upsert_fill_nulls", "S4_surrogate_key", "S10_constraint_check", "E3_search_match", "E7_ticker_claim",
    "T1_summary_stats", "T3_bootstrap_ci", "T5_welch_ttest", "T8_ols_hc3", "T9_ols_diagnostics",
    "T10_rf_classifier", "T13_cross_validation",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # workers must find the package whatever folder the bench is started from
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH")]))
    from tidemark.plans import all_queries
    from tidemark.session import local_session, release_scratch

    spark = local_session("tidemark-bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    names = [n for n in (sys.argv[1:] or HEADLINE)]
    known["W1_market_log_return"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    times = {}
    for name in names:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        release_scratch(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
