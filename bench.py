"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local cores. Each query runs once to warm up, then the median of three runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from checks import registered  # noqa: E402
from checks.data_queries import archived  # noqa: E402
from checks.registry import Inputs  # noqa: E402
from partledger.operators import verification  # noqa: E402
from partledger.session import configure  # noqa: E402
from partledger.sinks import archive as sink  # noqa: E402

QUERIES = [
    "content_fingerprint",
    "partition_changes",
    "fingerprint_documents",
    "revision_diff",
    "new_establishments",
    "group_listing",
    "detect_new",
    "verify_partitions",
    "audit_partitions",
    "manifest",
    "choose_sources",
    "certify_sources",
    "budget_over_all_partitions",
    "scan_dataset",
    "scan_from_manifest",
    "footer_row_counts",
    "scan_union_by_name",
    "period_filter",
    "count_by_establishment",
    "birth_risk_rates",
    "hospital_mortality",
    "establishment_presence",
    "name_establishments",
]
RUNS = 3


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    work()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("partledger-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tables = Inputs(spark, sf_dir)
    archived(tables)
    queries = registered.queries()
    results = {name: timed(lambda n=name: consume(queries[n](spark, sf_dir))) for name in QUERIES}

    lines = tables.lines
    results["write_partitions"] = timed(
        lambda: sink.write_partitions(lines, tables.folder("bench_write"), sort_cols=["l_shipdate", "l_suppkey"])
    )
    data = spark.read.option("basePath", archived(tables)).schema(lines.schema).parquet(archived(tables) + "/ano=*")
    results["footer_counts"] = timed(lambda: consume(verification.partition_row_counts(data)))
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
