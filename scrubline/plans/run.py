"""From four CSV exports to stage artifacts, reports and final tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.operators import accounting, pricing
from scrubline.operators.stages import Trace
from scrubline.operators.status import judged_rows
from scrubline.plans import cleaning, passes, staging, validation
from scrubline.sources.sinks import collect_log, in_row_order, write
from scrubline.sources.text import read_stamped, read_typed_csv

TABLES = tuple(cleaning.CHAINS)


def clean_to_storage(
    spark: SparkSession,
    table: str,
    source: str,
    output: str,
    fmt: str = "parquet",
    snapshots: bool = True,
    ordered: bool = False,
    line_breaks: str = "auto",
) -> Trace:
    """Clean one CSV export and write its artifacts.

    The wide trace is written once; every other artifact is read from it, each scanning
    only its own columns.  Rows stay in the order of their scan; ``ordered`` sorts snapshots
    and change logs across files too.
    """
    stamped = read_stamped(spark, source, table, line_breaks=line_breaks)
    trace = cleaning.clean_table(table, stamped).stored(f"{output}/{table}/trace")
    arrange = in_row_order if ordered else (lambda df: df)
    root = f"{output}/{table}"
    if snapshots:
        for stage in trace.stages:
            write(arrange(trace.snapshot(stage)), f"{root}/after_{stage}", fmt)
        if trace.omit:
            write(arrange(trace.snapshot(rows="kept")), f"{root}/kept", fmt)
    if trace.omit:
        write(trace.snapshot(rows="omitted"), f"{root}/omitted", fmt)
    if trace.change_points:
        changes = trace.changes()
        order = ("step", V.SOURCE_ROW, "column")
        changes = changes.orderBy(*order) if ordered else changes.sortWithinPartitions(*order)
        write(changes, f"{root}/changes", fmt, "step")
    # A summary has one row per rule: one file is enough.
    write(trace.summary().coalesce(1), f"{root}/summary", fmt)
    write(trace.cleaned(), f"{root}/cleaned", fmt)
    # Every row with its verdict and where it came from: what the load reads.
    write(judged_rows(trace), f"{root}/rows")
    return trace


def clean_all(
    spark: SparkSession,
    sources: dict[str, str],
    output: str,
    fmt: str = "parquet",
    snapshots: bool = True,
    ordered: bool = False,
    line_breaks: str = "auto",
) -> dict[str, Trace]:
    """Clean the given tables side by side (they share nothing) and roll up their summaries."""
    with ThreadPoolExecutor(len(sources)) as pool:
        jobs = {
            t: pool.submit(clean_to_storage, spark, t, path, output, fmt, snapshots, ordered, line_breaks)
            for t, path in sources.items()
        }
        traces = {t: job.result() for t, job in jobs.items()}
    log = collect_log(spark, [f"{output}/{t}/summary" for t in sources], fmt)
    write(log.coalesce(1), f"{output}/reports/cleaning_log", fmt)
    return traces


def read_cleaned(spark: SparkSession, output: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A load-ready table with its staging types."""
    schema = ", ".join(staging.STAGED[table])
    if fmt == "csv":
        return read_typed_csv(spark, f"{output}/{table}/cleaned", schema)
    return staging.typed(table, spark.read.format(fmt).load(f"{output}/{table}/cleaned"))


def validate_and_build(
    spark: SparkSession, output: str, fmt: str = "parquet", period=pricing.decade_period
) -> dict[str, str]:
    """Load, check, repair and check again until nothing changes; write reports, final tables, tiers.

    ``reports/excluded_records`` names every source row that no final table holds, with the rule
    that removed it, and ``reports/row_accounting`` proves that there are no others.
    """
    rows = {t: spark.read.parquet(f"{output}/{t}/rows") for t in TABLES}
    omitted = F.col("exclusion_reason").isNotNull()
    staged = {t: staging.traced(t, df.where(~omitted)) for t, df in rows.items()}

    def stored(df: DataFrame, name: str) -> DataFrame:
        return spark.read.parquet(write(df, f"{output}/staging/{name}"))

    loaded = {t: stored(df, t) for t, df in staging.load(staged).items()}
    done = passes.repair_passes(loaded, stored)
    counts = passes.all_counts(done)
    last = done[-1]
    first, repaired = passes.data(loaded), passes.data(last.tables)
    menus, items = staging.final_menu(repaired), staging.final_item(repaired)
    priced = pricing.fallback_prices(repaired["menu_item"], repaired["dish"])
    gone = [accounting.excluded(df.where(omitted), t, F.col("exclusion_reason")) for t, df in rows.items()]
    for rule, found in staging.ind_results(staged).items():
        gone.append(accounting.excluded(found, "menu_page" if rule == "IND-1" else "menu_item", rule))
    large = staging.too_large(last.tables["menu_item"], "price")
    gone += [*passes.excluded_in(done), accounting.excluded(large, "menu_item", V.Reason.PRICE_TOO_LARGE, last.number)]
    excluded = stored(reduce(DataFrame.unionByName, gone), "excluded")
    kept = {**last.tables, "menu_item": staging.fitting(last.tables["menu_item"], "price")}
    outputs = {
        "reports/ind": staging.ind_report(passes.data(staged)),
        "reports/violations": validation.violations(first, 0),
        "reports/violations_after": validation.violations(repaired, last.number),
        "reports/violation_delta": validation.violation_delta(counts),
        "reports/validation_report": validation.validation_report(counts),
        "reports/iteration_metrics": passes.iteration_metrics(done),
        "reports/excluded_records": excluded,
        "reports/row_accounting": accounting.row_accounting(rows, kept, excluded),
        "final/final_menu": menus,
        "final/final_item": staging.as_money(items, "clean_item_price"),
        "final/final_item_priced": staging.final_item_priced(priced, repaired["menu_page"]),
    }
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda kv: write(kv[1], f"{output}/{kv[0]}", fmt), outputs.items()))
    tiers = pricing.price_tiers(pricing.menu_averages(menus, items, period=period))
    write(tiers, f"{output}/final/price_tiers", fmt)
    return {name: f"{output}/{name}" for name in (*outputs, "final/price_tiers")}


def report(traces: dict[str, Trace], log: DataFrame) -> list[str]:
    """One printable line per table: its cell changes and the rules that made them."""
    rows = log.groupBy("table").agg(F.count(F.lit(1)).alias("rules"), F.sum("rows_affected").alias("n"))
    found = {r["table"]: r for r in rows.collect()}  # one row per table
    return [
        f"{t}: {found[t]['rules'] if t in found else 0} rules changed {found[t]['n'] if t in found else 0} cells"
        for t in traces
    ]
