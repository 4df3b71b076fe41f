"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

from __future__ import annotations

import json
import os
import time

from tallgrass.plans.queries import QUERIES
from tallgrass.session import session

HEADLINE = (
    "production_monthly decline_curve_inputs rollup_county rollup_operator rollup_field validate_batch dedup_latest pivot_product_kind "
    "gold_tests viz_county map_wells_latest cash_flow_series pv10 filter_outliers month_gaps"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(2):  # the second run has its code compiled
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
