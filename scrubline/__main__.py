"""Command line: ``python -m scrubline INPUT_DIR OUTPUT_DIR [table ...]``."""

from __future__ import annotations

import argparse
import sys

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import SparkSession

from scrubline.plans import run
from scrubline.sources.sinks import collect_log
from scrubline.sources.text import LINE_BREAKS, ShapeError, is_header_error


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="scrubline")
    parser.add_argument("input", help="folder with <table>.csv exports")
    parser.add_argument("output", help="folder for artifacts")
    parser.add_argument("tables", nargs="*", default=[])
    parser.add_argument("--format", default="parquet", choices=("csv", "parquet"))
    parser.add_argument("--no-snapshots", action="store_true")
    parser.add_argument("--ordered", action="store_true", help="snapshots and change logs in source row order")
    parser.add_argument(
        "--line-breaks", default="auto", choices=LINE_BREAKS,
        help="inside quotes: find such files and read each in one task, do so with every file, or refuse them",
    )
    args = parser.parse_args(argv)

    tables = args.tables or list(run.TABLES)
    unknown = [t for t in tables if t not in run.TABLES]
    if unknown:
        print(f"unknown tables {unknown}; choose from {list(run.TABLES)}")
        return 2
    spark = SparkSession.builder.appName("scrubline").getOrCreate()
    sources = {t: f"{args.input}/{t}.csv" for t in tables}
    try:
        traces = run.clean_all(
            spark, sources, args.output, args.format, not args.no_snapshots, args.ordered, args.line_breaks
        )
    except (AnalysisException, ShapeError) as error:
        print(str(error).splitlines()[0])
        return 1
    except (PySparkException, Py4JJavaError) as error:
        if not is_header_error(error):
            raise
        print("a file's header differs from the one its table declares")
        return 1
    log = collect_log(spark, [f"{args.output}/{t}/summary" for t in tables], args.format)
    print("\n".join(run.report(traces, log)))
    if set(tables) == set(run.TABLES):
        run.validate_and_build(spark, args.output, args.format)
    return 0


if __name__ == "__main__":
    sys.exit(main())
