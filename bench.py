"""

Each query: one warm-up, then the median of $BENCH_RUNS runs (default 5),
result written to the ``noop`` sink so the full plan executes without a
driver-side collect.  Times cover building the plan (including any size
checks and checkpoints the job makes) and running it.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    ("v12_enrich", "trip enrichment"),
    ("v09_hour_profile", "hourly percentile profile"),
    ("a12_rollup_grains", "roll-ups at three grains"),
    ("v01_histogram", "histogram"),
    ("v02_raster", "raster"),
    ("w01_topk_ties", "top-25 with ties"),
    ("v11_top_dest", "top destinations per origin"),
    ("m19_deciles", "deciles train vs later"),
    ("v23_daily_series", "pivoted daily series"),
    ("m04_simple_ols", "linear regression fit"),
]


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    scratch = tempfile.mkdtemp(prefix="lodestar-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lodestar-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "7g"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    from lodestar.plans.catalogue import CATALOGUE

    only = set(sys.argv[1:])
    results = {}
    for key, _label in HEADLINE:
        if only and key not in only:
            continue
        fn = CATALOGUE[key][0].job  # the job itself, without the oracle-comparison projection
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i:
                times.append(dt)
        results[key] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
