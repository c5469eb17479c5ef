"""Check, repair and exclude until nothing changes, each pass written and its counts carried on."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.operators import accounting
from scrubline.operators.checks import INTEGRITY_RULES, ind_kept, ind_violations
from scrubline.operators.repair import PAIR, ROW, after_repair, repair_ledger
from scrubline.plans import validation
from scrubline.plans.staging import Tables

#: What is done about a rule's violations; all others are accepted and reported.
REPAIR, EXCLUDE = "repair", "exclude"
DISPOSITIONS = {"IC-8": REPAIR, "FD-4": REPAIR, "IND-1": EXCLUDE, "IND-2": EXCLUDE, "IND-3": EXCLUDE}
#: Passes after which the loop ends even if counts still change.
MOST_PASSES = 20
ITEMS = "menu_item"

Store = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Pass:
    """Tables and violation counts after a pass, and the rows that it changed.

    ``ledgers`` hold, for the tables that it worked on, all rows from before with ``rule`` and
    ``removed``.  Pass 0 is the state that the loop starts from.
    """

    number: int
    tables: Tables
    counts: DataFrame
    ledgers: Tables = field(default_factory=dict)

    def changes(self, table: str) -> DataFrame:
        return self.ledgers[table].where("rule is not null")

    def excluded(self) -> list[DataFrame]:
        return [
            accounting.excluded(rows.where("rule is not null and removed"), t, F.col("rule"), self.number)
            for t, rows in self.ledgers.items()
        ]


def data(tables: Tables) -> Tables:
    """Tables without provenance."""
    return {t: df.drop(*ROW) for t, df in tables.items()}


def _ledger(tables: Tables, table: str, wanted: set[str], touched: DataFrame | None) -> DataFrame | None:
    """All rows of a table with what this pass does to each; None if no rule asks for anything."""
    df = tables[table]
    none = {f"kept_{c}": F.lit(None).cast(df.schema[c].dataType) for c in ROW}
    pieces: list[DataFrame] = []

    def going(rows: DataFrame, rule) -> None:
        pieces.append(rows.withColumns({"rule": rule, "removed": F.lit(True), **none}))

    rules = [r for r in INTEGRITY_RULES if r.table == table and r.rule_id in wanted and r.rule_id != "IC-8"]
    if rules:
        broken = F.coalesce(*(F.when(r.predicate(df), r.rule_id) for r in rules))
        going(df.where(broken.isNotNull()), broken)
        df = df.where(broken.isNull())
    for rule, child, key, parent in validation.IND_RULES:
        if child == table and rule in wanted:
            going(ind_violations(df, key, tables[parent]), F.lit(rule))
            df = ind_kept(df, key, tables[parent])
    repairs = table == ITEMS and wanted & {"IC-8", "FD-4"}
    if not pieces and not repairs:
        return None
    same = {"rule": F.lit(None).cast("string"), "removed": F.lit(False), **none}
    if not repairs:
        return reduce(DataFrame.unionByName, [*pieces, df.withColumns(same)])
    new = {"new_price": F.col("price"), "new_high_price": F.col("high_price")}
    near = df
    if touched is not None:
        near = validation.touching(df, touched, PAIR)
        far = validation.touching(df, touched, PAIR, "left_anti")
        pieces.append(far.withColumns(same))
    pieces = [p.withColumns(new) for p in pieces]
    return reduce(DataFrame.unionByName, [*pieces, repair_ledger(near)])


def _after(ledger: DataFrame, columns: list[str]) -> DataFrame:
    if "new_price" in ledger.columns:
        return after_repair(ledger, columns)
    return ledger.where(~F.col("removed")).select(*columns)


def repair_passes(
    tables: Tables,
    store: Store,
    dispositions: dict[str, str] | None = None,
    most: int = MOST_PASSES,
) -> list[Pass]:
    """Passes over ``tables`` (with provenance) until one changes no row or no rule's count.

    A pass looks at the rules that are violated and have a disposition: it excludes the violating
    rows or repairs them, on the state that the pass before left, so that rows which lose their
    parent in one pass are orphans of the next.  Every rule is counted in full once, at the start; a pass
    adds to the counts what its changed rows and the keys they touch add or take
    (:func:`validation.recount`).  After the first pass only (page, dish) groups that the pass
    before touched are looked at for repairs.
    """
    dispositions = DISPOSITIONS if dispositions is None else dispositions
    counts = store(validation.rule_counts(data(tables), 0).coalesce(1), "counts_0")
    passes = [Pass(0, tables, counts)]
    known = _known(counts)
    for number in range(1, most + 1):
        now = passes[-1]
        wanted = {r for r, n in known.items() if n and r in dispositions}
        touched = now.changes(ITEMS).select(*PAIR).distinct() if ITEMS in now.ledgers else None
        ledgers = {}
        for table in now.tables:
            if ITEMS == table and number > 1 and touched is None:
                made = _ledger(now.tables, table, wanted - {"IC-8", "FD-4"}, None)
            else:
                made = _ledger(now.tables, table, wanted, touched)
            if made is not None:
                made = store(made, f"ledger_{number}_{table}")
                if not made.where("rule is not null").isEmpty():
                    ledgers[table] = made
        if not ledgers:
            return passes
        after = {t: _after(ledgers[t], df.columns) if t in ledgers else df for t, df in now.tables.items()}
        changed = {t: rows.where("rule is not null") for t, rows in ledgers.items()}
        gone = {t: rows.select(*now.tables[t].columns) for t, rows in changed.items()}
        come = {t: _after(rows, now.tables[t].columns) for t, rows in changed.items()}
        counts = validation.recount(now.counts, data(now.tables), data(after), data(gone), data(come), number)
        counts = store(counts.coalesce(1), f"counts_{number}")
        passes.append(Pass(number, after, counts, ledgers))
        if _known(counts) == known:
            return passes
        known = _known(counts)
    warnings.warn(f"violations still change after {most} passes", stacklevel=2)
    return passes


def _known(counts: DataFrame) -> dict[str, int]:
    """Violations by rule: one row per rule."""
    return {r["rule_id"]: r["violations"] for r in counts.select("rule_id", "violations").collect()}


def all_counts(passes: list[Pass]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.counts for p in passes])


def work(passes: list[Pass]) -> DataFrame:
    """``iteration, rows_repaired, rows_excluded`` per pass, zeros for the start."""
    lines = []
    for p in passes:
        rows = [p.changes(t).select("removed") for t in p.ledgers]
        empty = p.counts.select(F.lit(False).alias("removed")).where(F.lit(False))
        lines.append(
            reduce(DataFrame.union, rows, empty).agg(
                F.lit(p.number).alias("iteration"),
                F.count_if(~F.col("removed")).alias("rows_repaired"),
                F.count_if(F.col("removed")).alias("rows_excluded"),
            )
        )
    return reduce(DataFrame.unionByName, lines)


def iteration_metrics(passes: list[Pass]) -> DataFrame:
    """Per pass: violations by family and left in all, rows repaired and excluded, sizes, and what
    changed against the pass before (NULL at the start)."""
    base = validation.iteration_metrics(all_counts(passes), {p.number: data(p.tables) for p in passes})
    total = F.col("ic_violations") + F.col("ind_violations") + F.col("fd_violations")
    metrics = base.join(work(passes), "iteration").withColumn("violations_remaining", total)
    in_order = Window.orderBy("iteration")  # one row per pass, at most as many as the loop may take
    step = lambda c: (F.col(c) - F.lag(c).over(in_order))
    return metrics.withColumns(
        {
            "change_in_violations": step("violations_remaining"),
            "change_in_eligible_items": step("eligible_items"),
            "change_in_eligible_menus": step("eligible_menus"),
        }
    )


def excluded_in(passes: list[Pass]) -> list[DataFrame]:
    """Rows excluded in any pass, in the shape of :func:`accounting.excluded`."""
    return [rows for p in passes for rows in p.excluded()]
