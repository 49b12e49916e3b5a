"""Time the headline queries on one machine and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads. All queries
run three times in turn, and the fastest run of each counts: the first warms the JVM up.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidemark.catalog import BATCH_QUERIES
from tidemark.sources.staging import release

HEADLINE = [
    "log_split_page",
    "log_split_display",
    "unique_visits",
    "bounces_10s",
    "bounces_6h",
    "visitor_stats_10s",
    "visitor_stats_1d",
    "order_interval_join_5d",
    "order_wide_user",
    "order_wide_dims",
    "order_wide_merge",
    "dim_lookup_composite",
    "cdc_route",
]


def session(cpus: int) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    """One run; the rows go to a sink that discards them."""
    begun = time.perf_counter()
    BATCH_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    taken = time.perf_counter() - begun
    release(spark)
    return round(taken, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    rounds = [{name: seconds(spark, sf_dir, name) for name in HEADLINE} for _ in range(3)]
    queries = {name: min(r[name] for r in rounds) for name in HEADLINE}
    spark.stop()
    result = {
        "metric": "total_query_time",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
