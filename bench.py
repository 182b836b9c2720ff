"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query runs to completion through the ``noop`` sink (no collect to the driver):
one warm-up pass over all queries, then ``$BENCH_RUNS`` timed passes; the reported time
per query is the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans import registry  # noqa: E402
from tidewater.session import local_session  # noqa: E402

HEADLINE = [
    "q12_monthly_series",
    "q1_readmission_view",
    "q3_patient_risk_view",
    "q7_admission_types_vs_global",
    "q8_provider_performance",
    "q11_patient_risk_profile",
    "q11_patient_risk_profile_corrected",
    "q9_glycemic_bands",
    "q10_text_search",
    "q13_describe",
    "q15_gdp_categories",
    "q16_life_change",
    "t5_exact_sample",
    "d7_d11_constraint_audit",
    "b1_sales_by_region",
    "b4_profitability",
    "b6_customer_segments",
    "q14_features",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = registry.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus) if cpus.isdigit() else 16)))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="tidewater-bench")
    for n in names:  # warm-up: JIT, file listing, broadcast code paths
        run_once(spark, n, sf_dir)
    times: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(runs):
        for n in names:
            times[n].append(run_once(spark, n, sf_dir))
    med = {n: round(statistics.median(v), 3) for n, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(med.values()), 3),
        "unit": "sec",
        "queries": med,
        "sf": sf,
        "runs": runs,
        "cpus": cpus,
        "shuffle_partitions": parts,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
