"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then the best of ``$BENCH_REPEAT``
(default 3) timed runs. A run executes the whole plan into Spark's ``noop``
sink (nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sales_by_category", "region_stats", "top_customers", "country_category", "monthly_base",
    "segment_category_distinct", "month_over_month", "outliers_iqr", "feature_chain",
    "currency_strict", "quality_strict", "history_build", "asof_lookup", "wordcount_nonword",
    "ngrams", "stream_tumbling",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from martlake.plans.registry import QUERIES, load_all
    from martlake.session import build_session, clean_scratch
    load_all()
    spark = build_session(master=f"local[{cpus}]", app="martlake-bench",
                          shuffle_partitions=int(cpus) * 2)
    times = {}
    for name in names:
        fn = QUERIES[name]

        def run():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        run()  # warm-up
        times[name] = round(min(run() for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "config": {"master": f"local[{cpus}]", "repeat": repeat,
                                 "spark": spark.version}}))
    clean_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
