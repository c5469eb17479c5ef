"""Times the whole job from CSV exports and the headline queries; prints one JSON line.

The input CSVs and the query phase's stored tables are prepared from the given parquet
tables.  ``clean_with_snapshots`` is comparable to the published cleaning run: four tables,
all stages, every snapshot, change log and summary written.  One untimed pass over a
tenth of the data warms the JVM up, as a job on a cluster runs far longer than its JIT.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scrubline.plans import cleaning, run  # noqa: E402
from scrubline.plans.catalog import QUERIES, Menus  # noqa: E402
from scrubline.sources import fixtures  # noqa: E402
from scrubline.sources.sinks import write  # noqa: E402

HEADLINE = (
    "row_status",
    "stage_summary",
    "change_log",
    "price_quantile",
    "violation_counts",
    "violation_report",
    "fd_4",
    "fd4_repair",
    "final_item",
    "price_fallback",
    "menu_avg",
    "price_tier",
    "cap_sensitivity",
    "profile",
)


def measure(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], int]:
    """Seconds per step and the rows cleaned."""
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sources, rows = {}, 0
    for table in run.TABLES:
        raw = fixtures.raw_table(spark, sf_dir, table)
        scope = {"menu": cleaning.scope_menu, "dish": cleaning.scope_dish}.get(table, lambda df: df)
        sources[table] = write(scope(raw), f"{work}/input/{table}.csv", "csv")
        rows += spark.read.csv(sources[table], header=True).count()

    times: dict[str, float] = {}

    def timed(name: str, job) -> None:
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)

    timed("clean_with_snapshots", lambda: run.clean_all(spark, sources, f"{work}/out"))
    timed("validate_repair_build", lambda: run.validate_and_build(spark, f"{work}/out"))
    timed("prepare_query_tables", lambda: Menus.of(spark, sf_dir).prepare())
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    return times, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scrubline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Many plans in one JVM: keep their generated classes and compiled code.
        .config("spark.sql.codegen.cache.maxEntries", "20000")
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=1g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if os.path.isdir(small) and os.path.abspath(small) != os.path.abspath(sf_dir):
        measure(spark, small)
    times, rows = measure(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time: CSV cleaning with snapshots, validation and repair, headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows_cleaned": rows,
                "rows_per_sec_cleaning": round(rows / times["clean_with_snapshots"]),
            }
        )
    )


if __name__ == "__main__":
    main()
