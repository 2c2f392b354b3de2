"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables, BENCH_CPUS: cores, BENCH_QUERIES: names to run instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tabveil.catalog import registered  # noqa: E402

HEADLINE = (
    "clean_strip_missing", "quantile_edges", "encode_table", "stratified_split", "standardise",
    "marginals_batch", "marginals_all_pairs", "mutual_information", "workload_repair",
    "epsilon_sweep", "consistency_8rounds", "sample_independent", "repair_step", "tree_sample",
    "roc_auc", "evaluate_scores", "clipped_gradient_step",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = registered()
    # One untimed scan loads the reader's classes and starts the Python workers.
    scan = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey").repartition(64)
    scan.mapInArrow(lambda batches: batches, "l_orderkey long").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.time()
        queries[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
