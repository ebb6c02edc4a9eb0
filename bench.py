"""Times the headline queries: one cold run, then the median of warm runs. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortweave import checks  # noqa: E402

HEADLINE = (
    "gold_outer_join", "flatten_wide", "find_participants", "row_positions", "provenance_hash", "column_profile",
    "outliers", "categorical_profile", "quality_issues", "cohort_describe", "correlations", "bundle_flatten",
    "observation_pivot", "registry_lookup", "fuzzy_search", "variable_search_fuzzy", "laplace_noise",
    "manifest_rollup", "status_counts", "incremental_ingest",
)
WARM_RUNS = int(os.environ.get("BENCH_WARM_RUNS", "3"))


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    checks.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checks.load()
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(WARM_RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total warm seconds of the headline queries", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
