"""Cleaning stages with row logs, change logs and summaries, as one lazy plan per table.

Running a chain adds columns and never overwrites one: each step keeps its
``struct<value, ops>`` beside the input.  A :class:`Trace` is that wide frame plus the
list of what happened, and every artifact is a projection or one aggregate of it:

* a snapshot is the values and the log as of one stage,
* the change log explodes the before/after pairs that differ,
* the summary is a single aggregate over all stages (the operation vocabulary is static),
* the load-ready table is the last snapshot without provenance.

Unused parts are pruned by Catalyst, so asking for clean values alone computes nothing
else.  ``Trace.stored`` writes the wide frame once when several artifacts are wanted.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from itertools import groupby
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.functions.cleaners import Cleaner, op_list, run_cleaners, two_decimals
from scrubline.operators.quantiles import quantile_row
from scrubline.vocab import Op, Reason

Lookup = Callable[[str], Column]

#: Three cleaners in one span make a method of more than 8000 bytes, which the JIT never compiles.
CLEANERS_PER_SPAN = 2


# --- what a stage may contain ----------------------------------------------
@dataclass(frozen=True)
class Apply:
    """Clean one column in place.

    ``record_changes=False`` keeps formatting-only work out of the change log;
    ``trivial_ops`` are operations that alone do not earn a change row.  Counts are
    complete either way.
    """

    column: str
    cleaner: Cleaner
    record_changes: bool = True
    trivial_ops: tuple[str, ...] = ()


@dataclass(frozen=True)
class Expand:
    """Derive several columns from one; the tag names the source, the count the results."""

    column: str
    cleaner: Cleaner
    into: tuple[str, ...]


@dataclass(frozen=True)
class Drop:
    """Remove a column, logged on every row; ``only_constant`` keeps it if it varies."""

    column: str
    only_constant: bool = False


@dataclass(frozen=True)
class Winsorize:
    """Cap values above the ``1 - limit`` quantile of the positive values, right tail only."""

    columns: tuple[str, ...]
    limit: float = V.WINSORIZE_UPPER_LIMIT


@dataclass(frozen=True)
class TagRows:
    """Mark whole rows by a predicate; marked rows leave the load-ready table."""

    column: str
    operation: str
    predicate: Callable[[Lookup], Column]


@dataclass(frozen=True)
class Note:
    """A count the steps do not make themselves, taken after the stage."""

    column: str
    operation: str
    predicate: Callable[[Lookup], Column]
    always: bool = False


@dataclass(frozen=True)
class Stage:
    name: str
    steps: tuple = ()
    notes: tuple[Note, ...] = ()


# --- what happened ----------------------------------------------------------
@dataclass(frozen=True)
class _Tag:
    stage: int
    text: Callable[[], Column]


@dataclass(frozen=True)
class _Count:
    stage: int
    column: str
    operation: str
    predicate: Callable[[], Column]
    always: bool = False


@dataclass(frozen=True)
class _Change:
    stage: int
    column: str
    row_id: str
    before: str
    after: str
    ops: str
    trivial: tuple[str, ...] = ()


@dataclass
class Trace:
    """A chain applied to one table; everything below is lazy."""

    table: str
    df: DataFrame
    stages: tuple[str, ...] = ()
    layouts: list[dict[str, str]] = field(default_factory=list)
    tags: list[_Tag] = field(default_factory=list)
    counts: list[_Count] = field(default_factory=list)
    change_points: list[_Change] = field(default_factory=list)
    kept_columns: list[str] = field(default_factory=list)
    omit: str | None = None
    omit_stage: int | None = None

    # -- views ---------------------------------------------------------------
    def _index(self, stage: str | None) -> int:
        return len(self.stages) - 1 if stage is None else self.stages.index(stage)

    def log(self, stage: str | None = None) -> Column:
        upto = self._index(stage)
        parts = [t.text() for t in self.tags if t.stage <= upto]
        return F.concat_ws(V.LOG_SEPARATOR, *parts) if parts else F.lit("")

    def snapshot(self, stage: str | None = None, *, rows: str = "all") -> DataFrame:
        """Values, provenance and log as of a stage; ``rows`` is all, kept or omitted."""
        at = self._index(stage)
        df, columns = self.df, [F.col(p).alias(n) for n, p in self.layouts[at].items()]
        columns += [F.col(V.SOURCE_FILE), F.col(V.SOURCE_ROW)]
        marks = self.omit is not None and self.omit_stage <= at
        if marks and rows != "all":
            df = df.where(F.col(self.omit) if rows == "omitted" else ~F.col(self.omit))
        if marks and rows != "kept":
            columns.append(F.col(self.omit).cast("int").alias(V.OMIT))
        return df.select(*columns, self.log(stage).alias(V.LOG))

    def cleaned(self) -> DataFrame:
        """The load-ready rows: data columns only, omitted rows left out."""
        return strip_provenance(self.snapshot(rows="kept"))

    def changes(self, stage: str | None = None) -> DataFrame:
        """Cell-level before/after of one stage, or of all with ``table`` and ``step``."""
        wanted = [
            c for c in self.change_points if stage is None or self.stages[c.stage] == stage
        ]
        cells, differs = [], F.lit(False)
        for c in wanted:
            before, after = F.col(c.before).cast("string"), F.col(c.after).cast("string")
            changed = F.coalesce(before, F.lit("")) != F.coalesce(after, F.lit(""))
            if c.trivial:
                trivial = F.array(*(F.lit(o) for o in c.trivial))
                changed &= F.size(F.array_except(F.col(c.ops), trivial)) > 0
            differs |= changed
            cells.append(
                F.struct(
                    F.lit(self.table).alias("table"),
                    F.lit(self.stages[c.stage]).alias("step"),
                    F.col(c.row_id).cast("string").alias("row_id"),
                    F.lit(c.column).alias("column"),
                    before.alias("before"),
                    after.alias("after"),
                    F.array_join(F.col(c.ops), V.LOG_SEPARATOR).alias("operations"),
                    changed.alias("changed"),
                )
            )
        columns = [F.col(n) for n in V.CHANGE_COLUMNS]
        if not cells:
            empty = {n: F.lit(None).cast("string").alias(n) for n in V.CHANGE_COLUMNS}
            empty[V.SOURCE_ROW] = F.col(V.SOURCE_ROW)
            df = self.df.where(F.lit(False)).select(*empty.values())
            return df if stage else df.select(
                F.lit("").alias("table"), F.lit("").alias("step"), *columns
            )
        out = (
            self.df.where(differs)
            .select(V.SOURCE_FILE, V.SOURCE_ROW, F.inline(F.array(*cells)))
            .where("changed")
        )
        return out.select(*columns) if stage else out.select("table", "step", *columns)

    def summary(self) -> DataFrame:
        """Rows affected per step, column and operation: one aggregate, then unpivoted."""
        counters, rows = [], []
        for i, c in enumerate(self.counts):
            counters.append(F.count_if(c.predicate()).alias(f"n{i}"))
            rows.append(
                F.struct(
                    F.lit(self.table).alias("table"),
                    F.lit(self.stages[c.stage]).alias("step"),
                    F.lit(c.column).alias("column"),
                    F.lit(c.operation).alias("operation"),
                    F.col(f"n{i}").alias("rows_affected"),
                    F.lit(c.always).alias("always"),
                )
            )
        return (
            self.df.agg(*counters)
            .select(F.inline(F.array(*rows)))
            .groupBy("table", "step", "column", "operation")
            .agg(F.sum("rows_affected").alias("rows_affected"), F.max("always").alias("always"))
            .where("always or rows_affected > 0")
            .select(*V.SUMMARY_COLUMNS)
        )

    def stored(self, path: str) -> Trace:
        """Write the wide frame and continue from the written copy."""
        self.df.write.mode("overwrite").parquet(path)
        return replace(self, df=self.df.sparkSession.read.parquet(path))


def strip_provenance(df: DataFrame) -> DataFrame:
    return df.drop(*V.PROVENANCE)


def run_stages(
    table: str, df: DataFrame, stages: tuple[Stage, ...], id_column: str = "id"
) -> Trace:
    """Apply a chain to a stamped frame (``source_file`` and ``source_row_num`` present)."""
    trace = Trace(table, df, tuple(s.name for s in stages))
    current = {n: n for n in df.columns if n not in V.PROVENANCE}
    for at, stage in enumerate(stages):
        for cleaning, steps in groupby(stage.steps, lambda s: isinstance(s, (Apply, Expand))):
            if cleaning:
                _clean(trace, at, list(steps), current, id_column)
                continue
            for step in steps:
                _STEPS[type(step)](trace, at, step, current, id_column)
        layout = dict(current)
        look = _lookup(layout)
        for note in stage.notes:
            trace.counts.append(
                _Count(at, note.column, note.operation, _later(note.predicate, look), note.always)
            )
        trace.layouts.append(layout)
    trace.df = fenced(trace.df, table)
    return trace


def fenced(df: DataFrame, label: str) -> DataFrame:
    """Observe the row count here.

    Filters are not pushed below an observation, so a predicate on a cleaned value reads
    the value instead of being rewritten into a second copy of the whole cleaning
    expression.  Generated code ends here too: one stage per span stays small enough for
    the JIT (measured: half the time of all cleaners in one).  Column pruning still passes.
    """
    return df.observe(f"{label}_{uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def _lookup(layout: dict[str, str]) -> Lookup:
    return lambda name: F.col(layout[name])


def _later(predicate: Callable[[Lookup], Column], look: Lookup) -> Callable[[], Column]:
    return lambda: predicate(look)


def _ops_tag(column: str, ops: str) -> Callable[[], Column]:
    def text() -> Column:
        joined = F.array_join(F.col(ops), f"{V.LOG_SEPARATOR}{column}:")
        return F.when(F.size(F.col(ops)) > 0, F.concat(F.lit(f"{column}:"), joined))

    return text


def _count_ops(trace: Trace, at: int, label: str, ops: str, names: tuple[str, ...]) -> None:
    for name in names:
        trace.counts.append(
            _Count(at, label, name, lambda n=name: F.array_contains(F.col(ops), n))
        )


def _clean(trace: Trace, at: int, steps: list, current: dict[str, str], id_column: str) -> None:
    """Run the cleaners of neighbouring steps side by side, a few per fence."""
    made = {step.column: f"{step.column}__{at}" for step in steps}
    jobs = [(step.cleaner, F.col(current[step.column]), made[step.column]) for step in steps]
    for first in range(0, len(jobs), CLEANERS_PER_SPAN):
        done = run_cleaners(trace.df, jobs[first : first + CLEANERS_PER_SPAN])
        trace.df = fenced(done, f"{trace.table}_{at}_{first}")
    for step in steps:
        value, ops = f"{made[step.column]}_value", f"{made[step.column]}_ops"
        trace.tags.append(_Tag(at, _ops_tag(step.column, ops)))
        if isinstance(step, Expand):
            current.update({name: f"{value}.{name}" for name in step.into})
            _count_ops(trace, at, ", ".join(step.into), ops, step.cleaner.names)
            continue
        before, row_id = current[step.column], current[id_column]
        current[step.column] = value
        _count_ops(trace, at, step.column, ops, step.cleaner.names)
        if step.record_changes:
            trace.change_points.append(
                _Change(at, step.column, row_id, before, value, ops, step.trivial_ops)
            )


def is_constant(df: DataFrame, column: str) -> bool:
    """At most one distinct non-null value: one aggregate, one row back."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return low == high


def _drop(trace: Trace, at: int, step: Drop, current: dict[str, str], id_column: str) -> None:
    if step.only_constant and not is_constant(trace.df, current[step.column]):
        warnings.warn(f"{trace.table}.{step.column} holds several values and is kept", stacklevel=2)
        return
    del current[step.column]
    tag = f"{step.column}:{Op.COLUMN_DROPPED}"
    trace.tags.append(_Tag(at, lambda: F.lit(tag)))
    trace.counts.append(_Count(at, step.column, Op.COLUMN_DROPPED, lambda: F.lit(True), True))


def _winsorize(
    trace: Trace, at: int, step: Winsorize, current: dict[str, str], id_column: str
) -> None:
    numbers = {c: F.col(current[c]).try_cast("double") for c in step.columns}
    caps = quantile_row(trace.df, numbers, 1 - step.limit)
    columns = trace.df.columns
    # One column holds the subquery, so that it is planned and run once.
    trace.df = trace.df.withColumn("_caps", caps)
    caps = F.col("_caps")
    over, values = {}, {}
    for column in step.columns:
        name = f"{column}__{at}"
        exceeds = F.coalesce(numbers[column] > caps[column], F.lit(False))
        over[f"{name}_over"] = exceeds
        values[f"{name}_value"] = F.when(
            F.col(f"{name}_over"), two_decimals(caps[column])
        ).otherwise(F.col(current[column]))
        values[f"{name}_ops"] = op_list((F.col(f"{name}_over"), Op.WINSORIZED))
    trace.df = trace.df.withColumns(over).withColumns(values).select(*columns, *values)
    for column in step.columns:
        name = f"{column}__{at}"
        trace.tags.append(_Tag(at, _ops_tag(column, f"{name}_ops")))
        for operation in (Op.WINSORIZED, Reason.SUSPICIOUS_EXTREME_PRICE):
            trace.counts.append(
                _Count(at, column, operation, lambda n=name: F.size(F.col(f"{n}_ops")) > 0)
            )
        trace.change_points.append(
            _Change(at, column, current[id_column], current[column], f"{name}_value", f"{name}_ops")
        )
        current[column] = f"{name}_value"


def _tag_rows(trace: Trace, at: int, step: TagRows, current: dict[str, str], id_column: str) -> None:
    name = f"{step.column}__{at}"
    mask = F.coalesce(step.predicate(_lookup(dict(current))), F.lit(False))
    trace.df = trace.df.withColumn(name, mask)
    tag = f"{step.column}:{step.operation}"
    trace.tags.append(_Tag(at, lambda: F.when(F.col(name), F.lit(tag))))
    trace.counts.append(_Count(at, step.column, step.operation, lambda: F.col(name), True))
    trace.omit, trace.omit_stage = name, at


_STEPS = {
    Drop: _drop,
    Winsorize: _winsorize,
    TagRows: _tag_rows,
}
